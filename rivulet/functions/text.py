"""Text expression helpers: tokenising, stop words, n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import col_of

# Runs of two or more Unicode letters / digits / underscores.  Written as an
# explicit class so that Java (Spark) and RE2 (the DuckDB oracle) agree; it is
# the ``(?u)\b\w\w+\b`` word rule of the common vectorisers.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: str | Column, lowercase: bool = True) -> Column:
    """Array of word tokens of a text column (lower-cased first by default)."""
    t = col_of(text)
    if lowercase:
        t = F.lower(t)
    return F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), 0)


def drop_stop_words(toks: Column, stop_words: Sequence[str]) -> Column:
    if not stop_words:
        return toks
    words = sorted(set(stop_words))
    return F.filter(toks, lambda t: ~t.isin(words))


def bigrams(toks: Column) -> Column:
    """Adjacent pairs ``"a b"`` of a token array (empty for < 2 tokens)."""
    n = F.size(toks)
    return F.when(n < 2, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n - 1),
                    lambda i: F.concat(F.element_at(toks, i), F.lit(" "),
                                       F.element_at(toks, i + 1))))


def uni_and_bigrams(toks: Column) -> Column:
    return F.concat(toks, bigrams(toks))


# The English stop list of the vectoriser library whose results
# the phrase drivers reproduce.
ENGLISH_STOP_WORDS = tuple("""
a about above across after afterwards again against all almost alone along already also although always am among
amongst amoungst amount an and another any anyhow anyone anything anyway anywhere are around as at back be became
because become becomes becoming been before beforehand behind being below beside besides between beyond bill both
bottom but by call can cannot cant co con could couldnt cry de describe detail do done down due during each eg eight
either eleven else elsewhere empty enough etc even ever every everyone everything everywhere except few fifteen fifty
fill find fire first five for former formerly forty found four from front full further get give go had has hasnt have
he hence her here hereafter hereby herein hereupon hers herself him himself his how however hundred i ie if in inc
indeed interest into is it its itself keep last latter latterly least less ltd made many may me meanwhile might mill
mine more moreover most mostly move much must my myself name namely neither never nevertheless next nine no nobody
none noone nor not nothing now nowhere of off often on once one only onto or other others otherwise our ours ourselves
out over own part per perhaps please put rather re same see seem seemed seeming seems serious several she should show
side since sincere six sixty so some somehow someone something sometime sometimes somewhere still such system take ten
than that the their them themselves then thence there thereafter thereby therefore therein thereupon these they thick
thin third this those though three through throughout thru thus to together too top toward towards twelve twenty two
un under until up upon us very via was we well were what whatever when whence whenever where whereafter whereas
whereby wherein whereupon wherever whether which while whither who whoever whole whom whose why will with within
without would yet you your yours yourself yourselves
""".split())


def default_stop_words() -> tuple[str, ...]:
    """The default stop list of the phrase drivers; plain data, no file or JVM needed."""
    return ENGLISH_STOP_WORDS
