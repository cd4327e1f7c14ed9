"""Text cleaning and tokens, as column expressions over whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: English function words to drop (a common public stop list)
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did doing "
    "a an the and but if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now"
).split()

# fixed values: patterns and character ranges to remove
URL = r"https?://\S+|www\.\S+"
HTML_TAG = r"(?d)<.*?>"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# fixed values: contraction endings and their expansions, applied in this order
CONTRACTIONS = (
    ("won't", "will not"),
    ("can't", "can not"),
    ("n't", " not"),
    ("'re", " are"),
    ("'s", " is"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'t", " not"),
    ("'ve", " have"),
    ("'m", " am"),
)

# fixed values: punctuation marks and the words that stand for them
MARK_WORDS = (("!", " exclamation "), ("?", " question "), ("'", " quotation "), ('"', " quotation "))


def merge_text(columns: Sequence[str]) -> Column:
    """Columns joined by one blank; a null counts as an empty string."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def remove_url(col: Column) -> Column:
    return F.regexp_replace(col, "(?U)" + URL, "")


def remove_emoji(col: Column) -> Column:
    return F.regexp_replace(col, EMOJI, "")


def remove_html(col: Column) -> Column:
    """Drops ``<...>`` spans that lie within one line."""
    return F.regexp_replace(col, HTML_TAG, "")


def remove_punct(col: Column) -> Column:
    return F.translate(col, PUNCTUATION, "")


def expand_contractions(col: Column) -> Column:
    for ending, words in CONTRACTIONS:
        col = F.replace(col, F.lit(ending), F.lit(words))
    return col


def normalize_text(col: Column) -> Column:
    """Written-out escapes and other marks become blanks, stop words go, lower case stays."""
    for escape in ("\\r", '\\"', "\\n"):
        col = F.replace(col, F.lit(escape), F.lit(" "))
    col = F.trim(F.regexp_replace(col, "[^A-Za-z0-9]+", " "))
    return F.lower(F.array_join(remove_stopwords(F.split(col, " "), ignore_case=True), " "))


def punct_to_words(col: Column) -> Column:
    """``Wow!`` becomes ``Wow exclamation`` (the mark's word is set between blanks)."""
    for mark, word in MARK_WORDS:
        col = F.replace(col, F.lit(mark), F.lit(word))
    return col


# fixed values: contraction endings split off a word, and the shape of one token
ENDINGS = r"(?i)(n't|'(s|re|ve|ll|d|m))\b"
TOKEN = r"[\p{L}\p{N}_]+([-./][\p{L}\p{N}_]+)*"


def tokenize(col: Column) -> Column:
    """Tokens of a text, keeping only wholly alphabetic ones.

    A word joined by ``-``, ``.`` or ``/`` is one token, so it is dropped.
    """
    tokens = F.regexp_extract_all(F.regexp_replace(col, ENDINGS, " "), F.lit(TOKEN), F.lit(0))
    return F.filter(tokens, lambda w: w.rlike(r"^\p{L}+$"))


def remove_stopwords(tokens: Column, ignore_case: bool = False) -> Column:
    return F.filter(tokens, lambda w: ~(F.lower(w) if ignore_case else w).isin(STOP_WORDS))


def words(col: Column, min_length: int = 2) -> Column:
    """Lower-case runs of at least ``min_length`` letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"[\p{L}\p{N}_]{%d,}" % min_length), F.lit(0))


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` neighbouring tokens, joined by blanks.

    Longer runs append the shifted tokens to the shorter ones; a run past the end is null and
    goes. No lambda looks back into the token array, so the work stays linear in the text.
    """
    sized, runs = [], tokens
    for n in range(1, high + 1):
        if n > 1:
            following = F.slice(tokens, n, F.size(tokens))
            runs = F.zip_with(runs, following, lambda a, b: F.concat(a, F.lit(" "), b))
        if n >= low:
            sized.append(runs)
    return F.array_compact(F.flatten(F.array(*sized)))


def string_hash(col: Column, m: int = 257, c: int = 1024) -> Column:
    """Polynomial hash over code points: ``h = (h * c + code) mod m``."""
    return F.aggregate(
        F.filter(F.split(col, ""), lambda x: x != ""),
        F.lit(0).cast("long"),
        lambda h, x: (h * c + F.ascii(x)) % m,
    )


def extract_label(col: Column) -> Column:
    """Text of an anchor tag."""
    return F.regexp_extract(col, "<a [^>]+>([^<]+)", 1)


def movie_year(title: Column) -> Column:
    """The first four digits in brackets."""
    return F.regexp_extract(title, r"\((\d{4})\)", 1).try_cast("int")


def movie_name(title: Column) -> Column:
    """What stands before the year."""
    return F.split(title, r"\(\d{4}\)")[0]


def strip_number(col: Column) -> Column:
    """Blanks inside a number removed, then a double (null when it is none)."""
    return F.regexp_replace(col, r"\s", "").try_cast("double")


def json_field(col: Column, path: str) -> Column:
    """One value of a JSON text column by path."""
    return F.get_json_object(col, path)
