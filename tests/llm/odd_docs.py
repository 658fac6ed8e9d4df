"""Small tables with the odd cases that every operator has to define."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


def make_docs(spark, texts, ids=None, langs=None):
    """A documents table; texts may be null, ids may repeat or be null."""
    ids = list(range(len(texts))) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    rows = [(i, t, lang, "src0", None if t is None else len(t)) for i, t, lang in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " ", "\n\n", "one", "Zoë\x85naïve á 日本語 <|endoftext|> x", "word " * 3000, "a" * 5000,
       "same text twice here", "same text twice here", "İ ẞ Σς ½ ①", "tab\tand\x0bvt\x0cff\rcr", "end."]
