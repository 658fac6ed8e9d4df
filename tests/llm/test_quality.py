import math
import random
import re
import unicodedata
from collections import Counter

import pytest
from odd_docs import ODD, make_docs
from pyspark.sql import functions as F

from rivulet.llm import quality as Q

SPACE = " \t\n\x0b\x0c\r"


def slow_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["a b c d e f g h " * 5, "x " * 30, "line one\nline one\n \n \nline two", "a b c d e f g h i j a b c d e f g h", "#*$% &|<> " * 4,
         "w1 w2 w3 w4 w5 w6 w7 w8 w9 w2 w3 w4 w5 w6 w7 w8 w9 w1"]


def test_counts_of_the_whole_table(docs):
    got = {r["doc_id"]: tuple(r[c] for c in NAMES) for r in Q.quality(docs).collect()}
    assert got == {r["doc_id"]: slow_counts(r["text"]) for r in docs.collect()}


def test_odd_rows(spark):
    texts = ODD + EXTRA
    ids = [None, 1, 1, *range(3, len(texts))]
    docs = make_docs(spark, texts, ids=ids, langs=[None, "en"] + ["de"] * (len(texts) - 2)).withColumn("t", F.lit("clash")).withColumn("n_words", F.lit(-1))
    rows = Q.quality(docs).collect()
    assert sorted(tuple(r[c] for c in NAMES) for r in rows) == sorted(map(slow_counts, texts))
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert Q.quality(docs.limit(0)).count() == 0


def slow_divergence(counts, reference):
    total, out = sum(counts), 0.0
    for n, q in zip(counts, reference, strict=True):
        p = n / total
        m = (p + q) / 2
        out += sum(x / 2 * math.log2(x / m) for x in (p, q) if x > 0)
    return out


KINDS = [r"[a-z]", r"[\x20\x09-\x0D]", r"[A-Z]", "[.,;:'\"!?()\\-]"]
FAILED = {"n_words": 20, "percent": 30}


def slow_classes(text):
    chars = [sum(bool(re.match(k, c)) for c in text) for k in KINDS]
    chars.append(sum(c.isnumeric() and not re.match("|".join(KINDS), c) for c in text))
    letters = sum(c.isalpha() and not c.isascii() for c in text)
    return [*chars, letters, len(text) - sum(chars) - letters]


def slow_references(rows, limits):
    """(shares of classes, {common word: share}) by language, from plain counts of every labelled row."""
    own = Counter(lang for _, lang in rows if lang is not None)
    large = sorted((k for k, n in own.items() if n >= limits.min_reference_rows), key=lambda k: (-own[k], k))[:limits.max_languages]
    groups = {}
    for text, lang in rows:
        n, _, _, _, again = slow_counts(text)
        if lang is not None and n >= FAILED["n_words"] and 100 * again <= FAILED["percent"] * n:
            groups.setdefault(lang if lang in large else None, []).append(text)
    out = {}
    for name, texts in groups.items():
        if len(texts) < limits.min_reference_rows:
            continue
        classes, words = [0.0] * (len(KINDS) + 3), Counter()
        for t in texts:
            classes = [a + b / len(t) / len(texts) for a, b in zip(classes, slow_classes(t), strict=True)]
            found = re.findall(r"[^\x20\x09-\x0D]+", t)
            for w in found:
                if w[0].isalpha() and all(c.isalpha() or c in "'’" for c in w) and len(w) <= limits.common_length:
                    words[w] += (1 << 30) // len(found)
        top = sorted(words, key=lambda w: (-words[w], w))[:limits.common_words]
        shares = {w: words[w] / (len(texts) << 30) for w in top}
        out[name] = (classes, shares if sum(shares.values()) >= limits.min_common_share else {})
    return out


def slow_distances(text, known, limits):
    words, chars = re.findall(r"[^\x20\x09-\x0D]+", text or ""), None
    by_char = by_word = None
    if len(text or "") >= limits.min_chars:
        chars = slow_classes(text)
        by_char = min(math.sqrt(max(0, slow_divergence(chars, ref[0]))) for ref in known.values())
    if len(words) >= limits.min_words and any(ref[1] for ref in known.values()):
        by_word = math.inf
        for _, shares in known.values():
            if shares:
                counts = [words.count(w) for w in shares]
                by_word = min(by_word, math.sqrt(max(0, slow_divergence(
                    [*counts, len(words) - sum(counts)], [*shares.values(), 1 - sum(shares.values())]))))
    return by_char, by_word


@pytest.mark.parametrize("limits", [Q.Limits(), Q.Limits(max_languages=2, common_words=7)])
def test_references_and_distances_of_the_whole_table(docs, limits):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    known, want = Q.references(docs, limits=limits), slow_references([r[1:] for r in rows], limits)
    assert set(known) == set(want) and {"de", "en"} <= set(known)
    for name, ref in known.items():
        assert ref.chars == pytest.approx(want[name][0], abs=1e-6)
        assert list(ref.words) == list(want[name][1]) and ref.shares == pytest.approx(list(want[name][1].values()), abs=1e-6)
    got = {r["doc_id"]: r for r in Q.judged(docs, known, limits=limits).collect()}
    for i, text, _ in rows:
        r, (by_char, by_word) = got[i], slow_distances(text, want, limits)
        for value, slow in ((r["char_distance"], by_char), (r["word_distance"], by_word)):
            assert value is None if slow is None else value == pytest.approx(slow, abs=1e-5)
        far = ((by_char is not None and by_char > limits.char_distance + limits.char_allowance / math.sqrt(len(text)))
               or (by_word is not None and by_word > limits.word_distance + limits.word_allowance / math.sqrt(r["n_words"])))
        assert r["kept"] == (not r["base_failed"] and not far)


def test_without_any_reference_only_the_plain_rules_reject(spark):
    docs = make_docs(spark, ["one two three " + "word%d " % i * 1 + " ".join(f"w{i}{k}" for k in range(40)) for i in range(5)], langs=[None] * 5)
    assert Q.references(docs) == {}
    assert all(r["kept"] for r in Q.quality(docs).collect())


def test_divergence_bounds(spark):
    row = spark.createDataFrame([([0.0, 4.0],)], "c array<double>").select(
        Q.divergence(F.col("c"), F.lit(4.0), [0.0, 1.0]).alias("same"), Q.divergence(F.col("c"), F.lit(4.0), [1.0, 0.0]).alias("apart")).first()
    assert (row["same"], row["apart"]) == (0.0, 1.0)


def test_junk_goes_and_prose_stays(spark, docs):
    known = Q.references(docs)
    junk = ["".join(chr(33 + (7 * i * i + 3 * k) % 60) for i in range(9)) for k in range(200)]
    frame = make_docs(spark, [" ".join(junk), " ".join("QXZ%d##" % k for k in range(300))])
    assert not any(r["kept"] for r in Q.judged(frame, known).collect())
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = Q.quality(table).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r["kept"] for r in rows if r["quality"] == 1) >= 0.995 * sum(r["quality"] == 1 for r in rows)
    assert sum(not r["kept"] for r in rows if r["quality"] == 0) >= 0.6 * sum(r["quality"] == 0 for r in rows)


def test_only_dataframe_functions(docs):
    plan = Q.quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)


def scrambled(docs):
    """Text of English documents with the letters of every word mixed."""
    rng, out = random.Random(5), []
    for r in docs.where("lang = 'en' AND n_chars > 800").limit(20).collect():
        out.append(" ".join("".join(rng.sample(w, len(w))) for w in r["text"].split()))
    return out


def test_a_label_exempts_nothing(spark, docs):
    known, texts = Q.references(docs), scrambled(docs)
    kept = {}
    for label in ("en", "xx", None):
        frame = make_docs(spark, texts, langs=[label] * len(texts))
        kept[label] = [r["kept"] for r in Q.judged(frame, known).orderBy("doc_id").collect()]
    assert kept["en"] == kept["xx"] == kept[None] and sum(kept["en"]) <= len(texts) // 4


def test_words_of_a_fifth_language_are_learned(spark, docs):
    rng = random.Random(8)
    little = ["ka", "mo", "re", "sul", "tan", "vi", "pe", "lor"]

    def prose():
        return " ".join(rng.choice(little) if rng.random() < 0.4 else "".join(rng.choice("aeioklmnprstv") for _ in range(rng.randint(4, 9)))
                        for _ in range(200))

    texts = [prose() for _ in range(60)]
    bare = [" ".join("".join(rng.choice("aeioklmnprstv") for _ in range(rng.randint(4, 9))) for _ in range(200)) for _ in range(10)]
    table = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(make_docs(spark, texts + bare, ids=range(10_000, 10_070), langs=["qq"] * 70))
    known = Q.references(table)
    assert set(little) <= set(known["qq"].words)
    kept = {r["doc_id"]: r["kept"] for r in Q.judged(table, known).collect()}
    assert all(kept[i] for i in range(10_000, 10_060)) and not any(kept[i] for i in range(10_060, 10_070))


def test_small_languages_share_a_reference(spark, docs):
    table = docs.select("doc_id", "text", F.when(F.col("lang") == "fr", F.concat(F.lit("fr"), F.col("doc_id") % 50))
                        .otherwise(F.col("lang")).alias("lang"), "source", "n_chars")
    known = Q.references(table)
    assert None in known and {"de", "la", "le"} <= set(known[None].words)
    plain = {r["doc_id"]: r["kept"] for r in Q.quality(docs).collect()}
    now = {r["doc_id"]: r["kept"] for r in Q.judged(table, known).collect()}
    assert sum(plain[i] != now[i] for i in plain) <= 0.03 * len(plain)


def test_a_very_long_document_is_not_the_language(spark, docs):
    odd = " ".join(f"zyx{chr(97 + k % 26)} wvu" for k in range(60_000))
    table = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(make_docs(spark, [odd], ids=[10_000]))
    assert "wvu" not in Q.references(table, limits=Q.Limits(common_words=10))["en"].words


def test_a_rare_language_is_judged_beside_many_rows_of_others(spark):
    def prose(word, n):
        return [" ".join(f"{word}{chr(97 + (i * k) % 23)}{chr(97 + (i + 7 * k) % 26)}" for k in range(90)) for i in range(n)]

    junk = " ".join("QXZ%d##" % k for k in range(300))
    short = ["too few words"] * 300
    texts = [*prose("north", 400), *prose("south", 8), *short, *prose("east", 6), junk, junk]
    langs = ["no"] * 400 + ["so"] * 8 + ["ea"] * 306 + ["so", "ea"]
    limits = Q.Limits(sample_rows=20)  # of "ea" hardly a sampled row passes
    frame = make_docs(spark, texts, langs=langs)
    known = Q.references(frame, limits=limits)
    assert sorted(known) == ["ea", "no", "so"]
    rows = {r["doc_id"]: r["kept"] for r in Q.judged(frame, known, limits=limits).collect()}
    assert not rows[len(texts) - 1] and not rows[len(texts) - 2]
    alone = make_docs(spark, texts[400:408], langs=langs[400:408])
    assert sorted(Q.references(alone, limits=limits)) == ["so"]


def test_references_are_fitted_on_every_row_and_rows_measured_once(spark):
    texts = [" ".join(f"w{chr(97 + (i * k) % 23)}{chr(97 + (i + 7 * k) % 26)}" for k in range(60)) for i in range(60)]
    frame = make_docs(spark, texts * 400, langs=["en"] * 24_000)
    late = make_docs(spark, [" ".join(["zebra", *t.split()]) for t in texts], ids=range(30_000, 30_060), langs=["en"] * 60)
    table = frame.unionByName(late)
    assert Q.references(table)["en"] == Q.references(table, limits=Q.Limits(sample_rows=100_000))["en"]
    few = make_docs(spark, texts, langs=["en"] * 60)
    known = Q.references(few)
    want = {r["doc_id"]: r.asDict() for r in Q.judged(few, known).collect()}
    got = {r["doc_id"]: r.asDict() for r in Q.quality(few).collect()}
    assert got == want


def test_only_words_that_may_be_common_are_written(spark):
    texts = ODD + EXTRA + ["l'été naïve étude x1 1x foo, (bar) baz- \U0001d400\U0001d401 'tis tis’ " + "y" * 40 + " " + "z" * 41 + "\x0bend"]
    rows = Q.measures(make_docs(spark, texts)).collect()

    def looks_common(w):
        marks = [c for c in w[1:] if unicodedata.category(c)[0] not in "LM" and c not in "'’"]
        return unicodedata.category(w[0])[0] == "L" and not marks and len(w) <= 40

    for r in rows:
        assert r["words"] == [w for w in re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or "") if looks_common(w)]


def test_common_words_are_counted_from_their_numbers(spark):
    common = ["the", "of", "a", "l'", "zz"]
    texts = ["the the of zz", "", "a", "x y", None, "of the a the l' zz zz zz the"]
    rows = Q.measures(make_docs(spark, texts), common=common).collect()
    assert {r["doc_id"]: r["commons"] for r in rows} == {i: [(t or "").split().count(w) for w in common] for i, t in enumerate(texts)}
    known = {"en": Q.Reference((1.0,) + (0.0,) * 6, ("rare", "often"), (0.1, 0.4)), None: Q.Reference((1.0,) + (0.0,) * 6, ("rare", "mid"), (0.3, 0.2))}
    assert Q._common(known) == ["often", "rare", "mid"]


def test_a_filter_by_the_verdict_counts_the_common_words_once(spark, docs):
    known = Q.references(docs)
    for frame in (Q.quality(docs), Q.judged(docs, known)):
        plan = frame.where("kept").select("doc_id")._jdf.queryExecution().optimizedPlan().toString()
        filters = [re.sub(r"#\d+", "", x).strip(" :+-") for x in plan.splitlines() if re.match(r"[ :+-]*Filter ", x)]
        assert filters == ["Filter (isnotnull(kept) AND kept)"]  # and not the verdict's expression, with the words counted for every reader
    assert Q.judged(docs, known).where("kept").count() == sum(r["kept"] for r in Q.judged(docs, known).collect())
