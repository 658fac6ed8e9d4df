import random

import pytest
from odd_docs import ODD, make_docs
from pyspark.sql import functions as F

from rivulet.llm import language as L


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(table):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    found = L.predict(table.where(held), L.fit(table.where(~held))).select("lang", "lang_pred", "score", "rejected").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in found)
    assert right >= 0.97 * len(found)
    assert sum(r["rejected"] for r in found) <= 0.02 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_odd_rows(spark, table):
    dictionaries = L.fit(table)
    assert sorted(dictionaries) == ["de", "en", "es", "fr"]
    assert all(len(d) <= L.DICTIONARY_BYTES + L.SAMPLE_TEXT_BYTES + 1 for d in dictionaries.values())
    ids = [None, 1, 1, *range(3, len(ODD))]
    docs = make_docs(spark, [*ODD, "12 34 !!"], ids=[*ids, 99]).withColumn("score", F.lit("clash")).withColumn("rejected", F.lit("x"))
    rows = L.predict(docs, dictionaries).collect()
    assert len(rows) == len(ODD) + 1
    for r in rows:
        letter = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == (not letter)
        assert r["rejected"] == (not letter or r["score"] < L.MIN_MARGIN)
    assert L.predict(docs.limit(0), dictionaries).count() == 0


def test_nothing_learned(spark):
    docs = make_docs(spark, ["some words", None], langs=[None, "en"])
    assert L.fit(docs) == {}
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in L.predict(docs, {}).collect()] == [("und", 0.0, True)] * 2
    one = L.predict(make_docs(spark, ["abc"]), {"en": b"abc abc"}).first()
    assert (one["lang_pred"], one["score"]) == ("en", 1.0)


def test_the_classifier_does_not_depend_on_neighbours(table):
    classify = L.classifier(L.fit(table))
    texts = [r["text"] for r in table.limit(40).collect()]
    assert [classify(t) for t in texts] == [L.classifier(L.fit(table))(t) for t in texts]


def test_the_margin_does_not_shrink_with_length(table):
    classify = L.classifier(L.fit(table))
    for lang in ("de", "en", "es", "fr"):
        words = " ".join(r["text"] for r in table.where(F.col("lang") == lang).orderBy("doc_id").limit(400).collect()).split()
        drawn = random.Random(5).choices(words, k=600_000)  # several MB of one language that do not repeat
        for n in (20_000, len(drawn)):
            found, margin = classify(" ".join(drawn[:n]))
            assert found == lang and margin > 10 * L.MIN_MARGIN
        assert len(" ".join(drawn)) > 3_000_000


def test_languages_whose_texts_are_all_long_are_learned(spark, table):
    books = {}
    for lang in ("de", "en", "es", "fr"):
        texts = [r["text"] for r in table.where(F.col("lang") == lang).orderBy("doc_id").limit(200).collect()]
        books[lang] = [" ".join(texts[i::2]) for i in range(2)]
        assert all(len(b.encode()) > L.SAMPLE_TEXT_BYTES for b in books[lang])
    texts = [books["de"][0], *books["en"], books["fr"][0], "short words of english"]
    learned = L.fit(make_docs(spark, texts, langs=["de", "en", "en", "fr", "en"]))
    assert sorted(learned) == ["de", "en", "fr"]
    assert len(learned["de"]) > L.SAMPLE_TEXT_BYTES  # the dictionary is filled although there is one text
    assert all(len(d) <= L.DICTIONARY_BYTES + L.SAMPLE_TEXT_BYTES + 1 for d in learned.values())
    found = L.predict(make_docs(spark, [books["de"][1], books["fr"][1]]), learned).collect()
    assert [(r["lang_pred"], r["rejected"]) for r in found] == [("de", False), ("fr", False)]
    less = L.fit(make_docs(spark, texts, langs=["de", "en", "en", "fr", "en"]), dictionary_bytes=3000, sample_text_bytes=100)
    assert len(less["de"]) == 3001 and len(less["en"]) <= 3003


@pytest.mark.parametrize("times", [50_000, 200_000])
def test_a_labelled_row_that_is_repeated_counts_once(spark, table, times):
    train = table.where(F.col("doc_id") % 5 > 0)
    one = train.where((F.col("lang") == "en") & (F.octet_length("text") < 500)).orderBy("doc_id").limit(1)
    again = one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("copy")
    assert L.fit(train.unionByName(again)) == L.fit(train)


def test_languages_beyond_the_limit_are_those_with_the_fewest_rows(spark):
    texts = [f"word{i} and more" for i in range(9)]
    docs = make_docs(spark, texts, langs=["a", "a", "a", "b", "b", "c", "d", "d", "d"])
    assert sorted(L.fit(docs, most_languages=3)) == ["a", "b", "d"]
    assert sorted(L.fit(docs)) == ["a", "b", "c", "d"]


def slow_classify(dictionaries, text):
    """The language and margin of one text, block by block with coders made anew for each."""
    import zstandard

    words = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    if not dictionaries or not any(map(str.isalpha, text or "")):
        return "und", 0.0
    data = L.normalised(text)
    assert data.decode().split() == words.split()
    sizes = []
    for name, content in dictionaries.items():
        size = 0
        for i in range(0, len(data), 32 * 1024):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=6)
            coder = zstandard.ZstdCompressor(level=6, dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False)
            size += len(coder.compress(data[i:i + 32 * 1024]))
        sizes.append((size, name))
    best, second = sorted(sizes)[:2]
    return best[1], 1 - best[0] / second[0]


def test_predictions_equal_the_slow_classifier_and_dictionaries_the_slow_choice(spark, table):
    few = table.where(F.col("doc_id") % 4 == 0)
    learned = L.fit(few, sample_rows=20)
    rows = few.where("lang IS NOT NULL AND text <> ''").select("lang", "text", F.xxhash64("doc_id", "text").alias("key")).collect()
    for lang in ("de", "en", "es", "fr"):
        least = sorted({(r["key"], r["text"]) for r in rows if r["lang"] == lang})[:20]
        content, take = b"", max(L.SAMPLE_TEXT_BYTES, L.DICTIONARY_BYTES // 20)
        for _, text in least:
            if len(content) < L.DICTIONARY_BYTES:
                content += L.normalised(text[:take])[:take] + b" "
        assert learned[lang] == content
    found = L.predict(few, learned).select("text", "lang_pred", "score").collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [slow_classify(learned, r["text"]) for r in found]
