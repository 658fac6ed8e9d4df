"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of labelled texts.
A document's words are compressed once with each dictionary; the language whose
dictionary leaves the fewest bytes wins.  The margin between the best and the
second best is the score; where it is narrow the document is rejected.  Long
texts are compressed in blocks of ``BLOCK_BYTES``, each with the fresh
dictionary, and the sizes are summed: in one piece, a text soon is its own
dictionary and the margin would shrink with its length.

The dictionaries are fitted on a bounded sample: the ``SAMPLE_ROWS`` labelled
rows of each language whose hash of id and text is least, among texts of every
length, and ``DICTIONARY_BYTES`` of their text.  A text gives its first
``SAMPLE_TEXT_BYTES``, or more where a language has too few rows to fill its
dictionary otherwise.  Prediction is row-local over whole texts; what is sent
to the executors are the dictionaries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN = "und"
DICTIONARY_BYTES = 256 << 10
SAMPLE_ROWS = 300
#: Languages that are learned at most: those with the most different labelled rows.
MOST_LANGUAGES = 256
#: Bytes that one text gives to a dictionary which has texts enough.
SAMPLE_TEXT_BYTES = 8 << 10
LEVEL = 6
#: Bytes of a text that are compressed together; all of its blocks count.
BLOCK_BYTES = 32 << 10
#: Smallest share of the second-best size by which the best must be smaller.
MIN_MARGIN = 0.002
OTHER = re.compile(r"[\W\d_]+")


def normalised(text: str) -> bytes:
    """Lower-case words with one space between: marks, digits and case tell nothing about the language."""
    return OTHER.sub(" ", text.lower()).encode()


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        dictionary_bytes: int = DICTIONARY_BYTES, sample_rows: int = SAMPLE_ROWS,
        sample_text_bytes: int = SAMPLE_TEXT_BYTES, most_languages: int = MOST_LANGUAGES) -> dict[str, bytes]:
    """Raw dictionary content of each language, from rows whose text and language are not null.

    Every language that labels a text is learned, however long its texts are
    and however often a row is repeated: a row counts once for its language.
    Only where a label column holds more than ``most_languages`` values the
    ones with the fewest different rows are left out (ties by name), so that
    what the driver holds and sends stays bounded.  Of a chosen text the first
    ``sample_text_bytes`` are taken; of each text of a language with fewer than
    ``dictionary_bytes / sample_text_bytes`` rows, an equal share of the dictionary.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    keys = rows.select("lang", "key").distinct()  # numbers only: repeated rows leave each task once
    found = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    if not found:
        return {}
    takes = {r["lang"]: max(sample_text_bytes, dictionary_bytes // min(r["n"], sample_rows)) for r in found}
    rank = F.row_number().over(W.partitionBy("lang").orderBy("key"))
    chosen = keys.where(F.col("lang").isin(sorted(takes))).withColumn("rank", rank).where(F.col("rank") <= sample_rows)
    take = F.create_map(*[F.lit(x) for pair in sorted(takes.items()) for x in pair])[F.col("lang")]
    sample = rows.join(F.broadcast(chosen.drop("rank")), ["lang", "key"]).groupBy("lang", "key").agg(
        F.min(F.substring("text", F.lit(1), take)).alias("text"))
    content: dict[str, bytes] = {name: b"" for name in sorted(takes)}
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["key"])):  # at most sample_rows of each language
        if len(content[r["lang"]]) < dictionary_bytes:
            content[r["lang"]] += normalised(r["text"])[:takes[r["lang"]]] + b" "
    return {name: c for name, c in content.items() if c}


def classifier(dictionaries: dict[str, bytes]):
    """A function from a text to (language, margin)."""
    names = sorted(dictionaries)
    coders = []
    for name in names:
        content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False,
                                               write_dict_id=False, write_checksum=False))

    def classify(text: str | None) -> tuple[str, float]:
        if not names or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        data = memoryview(normalised(text))
        blocks = [data[i:i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = sorted((sum(len(coder.compress(b)) for b in blocks), name) for name, coder in zip(names, coders, strict=True))
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0]

    return classify


def predict(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text",
            min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` (the margin, 0 to 1) and ``rejected``.

    Null text and text without a letter are ``und`` with score 0, and rejected;
    so is every text when nothing was learned.  Languages that tie are taken in
    order of name, with score 0.  Ids, repeated rows and further columns pass
    unchanged; columns with the three names are replaced.
    """
    rest = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    frame = docs.select(*rest)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields),
                        "lang_pred string", "score double", "rejected boolean"])
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = classifier(shared.value)
        for batch in batches:
            found = [classify(t.as_py()) for t in batch.column(text)]
            names, scores = [f[0] for f in found], [f[1] for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array([n == UNKNOWN or s < min_margin for n, s in found], pa.bool_())],
                names=[*rest, "lang_pred", "score", "rejected"])

    return frame.mapInArrow(run, schema)
