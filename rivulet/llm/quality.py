"""Quality rules by distribution distance, in DataFrame functions only.

A document's histogram over character classes and its histogram over a
language's common words are compared with that language's own histograms
(Jensen-Shannon distance, base 2: 0 for equal, 1 for disjoint).  The document is
rejected when even the nearest language is further than a threshold, whatever
its label says.  A comparison is only made from a minimum length on, below which
a histogram says little.  Plain counts (length, repeats) reject first.

Everything about a document is computed in its own row, once: the counts and
the words that could be common ones are written, then read for the references
and for the verdicts.  The
language references, common words included, are means over all labelled rows
that pass the plain rules (a caller may ask for a sample).  Every row weighs the same in a mean,
so that a very long document does not become the language.  Languages with few
labelled rows, and those beyond the largest ``max_languages``, share one
reference.  What the driver holds is a short histogram for each reference.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: White space that separates words.
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Character classes, taken out of the text one after the other; the last class is all that remains.
CLASSES = {"lower": "[a-z]+", "space": SPACE + "+", "upper": "[A-Z]+", "point": r"[.,;:'\"!?()\-]+",
           "digit": r"\p{N}+", "letter": r"[\p{L}\p{M}]+"}

#: What a common word looks like: a letter, then letters, marks and apostrophes.
COMMON = r"\p{L}[\p{L}\p{M}'’]"

#: A row's weight in the sums of a reference: shares of a row are integers, so sums do not depend on their order.
WHOLE = 1 << 30


@dataclass(frozen=True)
class Reference:
    """Mean shares of a language's rows."""

    #: Shares of the character classes, the rest last.
    chars: tuple[float, ...]
    #: Common words and their shares of all words; empty where the language has none.
    words: tuple[str, ...] = ()
    shares: tuple[float, ...] = ()


#: References by language; under None the one that the small languages share.
References = dict[str | None, Reference]


@dataclass(frozen=True)
class Limits:
    """Parameters of the divergence rules."""

    #: Largest distance from the nearest language's character classes, what short texts are
    #: allowed beside it (divided by the root of the code points), and the code points from which it counts.
    char_distance: float = 0.31
    char_allowance: float = 0.6
    min_chars: int = 200
    #: The same for common words, by words.
    word_distance: float = 0.17
    word_allowance: float = 1.5
    min_words: int = 60
    #: Rows of each language that references are fitted on (expected number; None: all), and those that must pass the plain rules.
    sample_rows: int | None = None
    min_reference_rows: int = 5
    #: Languages with a reference of their own: those with the most labelled rows.
    max_languages: int = 32
    #: Common words of a language, the code points that one may have, and the least share of a
    #: language's words that they must hold to say anything.
    common_words: int = 40
    common_length: int = 40
    min_common_share: float = 0.05


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pinned(value: Column) -> Column:
    """The value, computed where it stands: filters above are not pushed below it,
    which would write it out again inside every lambda that reads it."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def _repeat_words(hashes: Column) -> Column:
    """Words that lie in windows whose hash occurs more than once."""
    def marked(pairs: Column) -> Column:
        return F.filter(pairs, lambda p, j: (p["h"] == F.get(pairs, j - 1)["h"]) | (p["h"] == F.get(pairs, j + 1)["h"]))

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = F.array_sort(F.transform(_let(pairs, marked), lambda p: p["i"]))
    zero = F.struct(F.lit(0).alias("covered"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(starts, zero, lambda a, s: F.struct(
        (a["covered"] + F.least(F.lit(WINDOW), s - a["last"])).alias("covered"), s.alias("last")))["covered"]


def _windows(words: Column) -> Column:
    """A hash for each window, of two windows half as long: the hashes of the words are taken up in three steps."""
    def joined(hashes: Column, k: int) -> Column:  # the last k have no second half: they are cut off in the end
        return _let(hashes, lambda h: F.zip_with(h, F.slice(h, 1 + k, F.greatest(F.size(h) - k, F.lit(0))), lambda a, b: F.xxhash64(a, b)))

    hashes, k = F.transform(words, lambda w: F.xxhash64(w)), 1
    while k < WINDOW:
        hashes, k = joined(hashes, k), 2 * k
    return _let(hashes, lambda h: F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))))


def _found(words: Column, common: Sequence[str]) -> Column:
    """Numbers of the common words found, in order, each number once more: a word's count is the way to the next number's first place."""
    if not common:
        return F.array().cast("array<int>")
    numbers = F.transform(F.filter(words, lambda w: w.isin(list(common))),
                          lambda w: F.array_position(F.array(*map(F.lit, common)), w).cast("int"))
    return F.sort_array(F.concat(numbers, F.sequence(F.lit(1), F.lit(len(common) + 1))))


def _commons(found: Column, common: Sequence[str]) -> Column:
    """How often each common word occurs, from the numbers found."""
    if not common:
        return found
    starts = F.transform(found, lambda k, i: F.when(F.coalesce(F.get(found, i - 1) != k, F.lit(True)), i))
    places = F.filter(starts, lambda i: i.isNotNull())
    return _let(places, lambda p: F.transform(F.sequence(F.lit(1), F.lit(len(common))), lambda k: F.get(p, k) - F.get(p, k - 1) - 1))


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *keep: str, common: Sequence[str] | None = None,
             longest: int = Limits.common_length) -> DataFrame:
    """The columns ``keep``, doc_id, the plain counts and ``chars`` (counts of the character classes).

    With ``common`` also ``commons``, how often each of these words occurs; without it
    ``words``, those that look like a common word and have at most ``longest`` code points.
    """
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    base = [*keep, "doc_id"]
    t = docs.select(*keep, F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = t.select(*base, "t", F.length("t").alias("n"), F.btrim("t", F.lit(SPACES)).alias("trimmed"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    t = t.select(*base, "t", "n", lines.alias("lines"),
                 _pinned(F.when(F.col("trimmed") == "", F.array().cast("array<string>"))
                         .otherwise(F.split("trimmed", SPACE + "+"))).alias("words"))
    words = F.col("words")
    windows = F.when(F.size(words) >= WINDOW, _windows(words))
    candidate = rf"(?<![^\x20\x09-\x0D]){COMMON}{{0,{longest - 1}}}+(?![^\x20\x09-\x0D])"  # once over the text, not once for each word
    candidates = F.regexp_extract_all("t", F.lit(candidate), F.lit(0))
    last, found = ("words", candidates) if common is None else ("commons", _found(words, common))
    t = t.select(*base, "t", "n", F.size(words).cast("long").alias("n_words"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 _pinned(windows).alias("windows"), found.alias("found"))
    t = t.select(*base, "t", "n", "n_words", "n_dup_lines", "found",
                 F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _repeat_words(F.col("windows")))
                 .otherwise(0).cast("long").alias("n_repeat_words"))
    sizes = [F.col("n")]
    for name, pattern in CLASSES.items():  # what is left of the text shrinks from step to step
        if name == "upper":
            t = t.withColumn("n_symbols", F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long"))
        t = t.withColumn("t", F.regexp_replace("t", pattern, "")).withColumn(f"left_{name}", F.length("t"))
        sizes.append(F.col(f"left_{name}"))
    chars = [a - b for a, b in zip(sizes, [*sizes[1:], F.lit(0)], strict=True)]
    value = _commons(F.col("found"), common or ())
    return t.select(*base, *(F.col(c) if c != "word_chars" else (F.col("n") - chars[1]).cast("long").alias(c) for c in counted),
                    _pinned(F.col("n").cast("long")).alias("n_chars"),
                    F.transform(F.array(*chars), lambda x: x.cast("double")).alias("chars"), value.alias(last))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _sums(sample: DataFrame, limits: Limits) -> DataFrame:
    """``lang, cell, x`` over the measured rows that pass the plain rules.

    Summed shares of the character classes (cell " 0" and so on) and of the most
    frequent words, and the number of rows (cell " ").  No word starts with a space.
    """
    m = sample.where(~base_failed())
    classes = [F.struct(F.lit(f" {i}").alias("cell"), F.floor(F.get("chars", i) * WHOLE / F.col("n_chars")).alias("x"))
               for i in range(len(CLASSES) + 1)]
    one = F.struct(F.lit(" ").alias("cell"), F.lit(1).cast("long").alias("x"))
    fixed = m.select("__lang", F.explode(F.array(one, *classes)).alias("c")).select("__lang", "c.cell", "c.x")
    words = m.select("__lang", F.explode("words").alias("cell"), F.floor(F.lit(WHOLE) / F.col("n_words")).alias("x"))
    sums = fixed.unionByName(words).groupBy(F.col("__lang").alias("lang"), "cell").agg(F.sum("x").alias("x"))
    rank = F.row_number().over(Window.partitionBy("lang", F.col("cell").startswith(" ")).orderBy(F.desc("x"), "cell"))
    most = max(limits.common_words, len(CLASSES) + 2)  # the fixed cells are as many
    return sums.withColumn("rank", rank).where(F.col("rank") <= most)


def references(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
               limits: Limits = Limits()) -> References:
    """Mean shares of character classes and of its own common words for each language.

    A language has a reference when at least ``min_reference_rows`` of its rows
    pass the plain rules; those with fewer labelled rows, or beyond the largest
    ``max_languages``, have one together.  A language whose common words hold
    less than ``min_common_share`` of its words has none to compare with.
    Rows without label or text take no part; an empty table has no references.
    """
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"), F.col(lang).alias("__label"))
    return _references(measures(rows, "__id", "__text", "__label", longest=limits.common_length), limits)


def _references(measured: DataFrame, limits: Limits) -> References:
    """:func:`references` of rows that are measured, with their words and their label as ``__label``."""
    rows = measured.where(F.col("__label").isNotNull())
    counts = rows.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= limits.min_reference_rows)
    own = {r["__label"]: r["n"] for r in counts.orderBy(F.desc("n"), "__label").limit(limits.max_languages).collect()}
    mine = F.col("__label").isin(list(own)) if own else F.lit(False)
    shared = rows.where(~mine).count()
    sizes: dict[str | None, int] = {**own, **({None: shared} if shared >= limits.min_reference_rows else {})}
    if not sizes:
        return {}
    rows = rows.withColumn("__lang", F.when(mine, F.col("__label")))

    def of(names: list) -> Column:
        named = [x for x in names if x is not None]
        return (F.col("__lang").isin(named) if named else F.lit(False)) | (F.col("__lang").isNull() & F.lit(None in names))

    def add(sample: DataFrame) -> None:
        for r in _sums(sample, limits).collect():  # one short histogram for each reference
            found.setdefault(r["lang"], {})[r["cell"]] = r["x"]
        for name in [k for k, cells in found.items() if cells.get(" ", 0) < limits.min_reference_rows]:
            del found[name]

    found: dict[str | None, dict[str, int]] = {}
    if limits.sample_rows is None:
        add(rows.where(of(list(sizes))))
        return {name: _reference(found[name], limits) for name in sorted(found, key=lambda x: (x is not None, x or ""))}
    parts = {name: int(min(1.0, limits.sample_rows / n) * WHOLE) for name, n in sizes.items()}
    bound = F.lit(parts.get(None, 0))
    for name, part in sorted((k, x) for k, x in parts.items() if k is not None):
        bound = F.when(F.col("__lang") == name, F.lit(part)).otherwise(bound)
    add(rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(WHOLE)) < bound))
    few = [name for name, part in parts.items() if part < WHOLE and name not in found]
    if few:  # too few of the sampled rows pass: all rows of these languages
        add(rows.where(of(few)))
    return {name: _reference(found[name], limits) for name in sorted(found, key=lambda x: (x is not None, x or ""))}


def _reference(cells: dict[str, int], limits: Limits) -> Reference:
    chars = [cells[f" {i}"] for i in range(len(CLASSES) + 1)]
    total = cells[" "] * WHOLE
    ranked = sorted((w for w in cells if not w.startswith(" ")), key=lambda w: (-cells[w], w))[:limits.common_words]
    if sum(cells[w] for w in ranked) < limits.min_common_share * total:
        ranked = []
    return Reference(tuple(x / sum(chars) for x in chars), tuple(ranked), tuple(cells[w] / total for w in ranked))


def divergence(counts: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon divergence (base 2) of a histogram of counts from reference shares."""
    def term(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        return (F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)) / 2

    terms = F.zip_with(counts, F.array(*map(F.lit, reference)), lambda n, q: term(n / total, q))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def distance(counts: Column, total: Column, reference: Sequence[float]) -> Column:
    """Jensen-Shannon distance: the root of the divergence (which rounding may leave below zero)."""
    return F.sqrt(F.greatest(divergence(counts, total, list(reference)), F.lit(0.0)))


def judged(docs: DataFrame, known: References, doc_id: str = "doc_id", text: str = "text", limits: Limits = Limits(),
           keep: tuple[str, ...] = ()) -> DataFrame:
    """Plain counts, the distances from the nearest language, ``base_failed`` and ``kept`` of every row.

    Every document is compared with every reference; its label is not read, so
    a wrong or unknown label exempts nothing.  A distance is null below its
    minimum length or without any reference; it then rejects nothing.  A
    document of a language that no reference knows is as far as its
    distributions are.  Null text counts as empty; null ids, repeated rows and
    clashing further columns do no harm; the columns ``keep`` pass.
    """
    common = _common(known)
    return _verdicts(measures(docs, doc_id, text, *keep, common=common), known, common, limits)


def _common(known: References) -> list[str]:
    """All common words; the most frequent come first, where they are found soonest."""
    most: dict[str, float] = {}
    for ref in known.values():
        for w, share in zip(ref.words, ref.shares, strict=True):
            most[w] = max(share, most.get(w, 0.0))
    return sorted(most, key=lambda w: (-most[w], w))


def _verdicts(m: DataFrame, known: References, common: Sequence[str], limits: Limits) -> DataFrame:
    """:func:`judged` of rows that are measured, with their counts of the common words."""
    def of_words(ref: Reference) -> Column:
        own = F.transform(F.array(*(F.lit(common.index(w)) for w in ref.words)), lambda k: F.get("commons", k).cast("double"))
        rest = F.col("n_words") - F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        return distance(F.concat(own, F.array(rest)), F.col("n_words"), [*ref.shares, max(0.0, 1.0 - sum(ref.shares))])

    def nearest(found: list[Column]) -> Column:
        return F.array_min(F.array(*found)) if found else F.lit(None).cast("double")

    by_char = nearest([distance(F.col("chars"), F.col("n_chars"), ref.chars) for ref in known.values()])
    by_word = nearest([of_words(ref) for ref in known.values() if ref.words])
    m = m.withColumn("char_distance", F.when(F.col("n_chars") >= limits.min_chars, by_char))
    m = m.withColumn("word_distance", F.when(F.col("n_words") >= limits.min_words, by_word))
    far = F.lit(False)
    for k, most, allowed, n in (("char_distance", limits.char_distance, limits.char_allowance, "n_chars"),
                                ("word_distance", limits.word_distance, limits.word_allowance, "n_words")):
        far = far | F.coalesce(F.col(k) > F.lit(most) + F.lit(allowed) / F.sqrt(F.greatest(F.col(n), F.lit(1))), F.lit(False))
    # pinned: a caller's filter by the verdict would else be computed below, with the common words counted anew for each that a reference reads
    return (m.withColumn("base_failed", base_failed()).withColumn("kept", _pinned(~F.col("base_failed") & ~far))
            .drop("chars", "commons", "n_chars"))


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
            limits: Limits = Limits(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Fit the language references on all of ``docs`` and judge every row of it; what is measured is written once."""
    rows = docs.select(*keep, F.col(doc_id).alias("__id"), F.col(text).alias("__text"), F.col(lang).alias("__label"))
    m = materialize(measures(rows, "__id", "__text", "__label", *keep, longest=limits.common_length), "quality", "zstd")
    known = _references(m, limits)
    common = _common(known)
    numbered = m.withColumn("found", _pinned(_found(F.col("words"), common))).drop("words", "__label")
    return _verdicts(numbered.withColumn("commons", _commons(F.col("found"), common)).drop("found"), known, common, limits)
