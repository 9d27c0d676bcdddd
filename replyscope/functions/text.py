"""Text cleaning, tokens and n-gram terms as native Column expressions."""

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyscope.functions.columns import col

# Whitespace as Unicode text software defines it.
SPACE = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
NOT_SPACE = SPACE.replace("[", "[^", 1)
# A run of whitespace that is more than one blank: most runs are one, and stay as they are.
WIDE_SPACE = f"{SPACE}(?:(?<! ){SPACE}*|{SPACE}+)"
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

# URL prefixes, courtesy phrases and token shape.
URL = f"http{NOT_SPACE}+|www{NOT_SPACE}+"
URL_STARTS = ["http", "www"]
BOILERPLATE = [
    r"dear customer,?",
    r"thank you for contacting us,?",
    r"we appreciate your patience,?",
    r"best regards,?",
    r"sincerely,?",
    r"thanks,?",
]
TOKEN = r"([\p{L}\p{N}_]{2,})"

# Spark's default English stop words.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what which "
    "who whom this that these those am is are was were be been being have has had having do "
    "does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will "
    "just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd "
    "they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't "
    "wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's "
    "what's when's where's who's why's would"
).split()


def strip(c) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only drops blanks)."""
    return F.btrim(col(c), F.lit(SPACES))


def _where_found(c: Column, pieces: list[str], change: Callable[[Column], Column]) -> Column:
    """A change of those texts only that hold one of the pieces; ``c`` is computed once."""

    def changed(text: Column) -> Column:
        return F.when(reduce(or_, [F.contains(text, F.lit(p)) for p in pieces]), change(text)).otherwise(text)

    return F.get(F.transform(F.array(c), changed), F.lit(0))


def clean_text(c) -> Column:
    lowered = F.lower(F.coalesce(col(c), F.lit("")))
    without_urls = _where_found(lowered, URL_STARTS, lambda text: F.regexp_replace(text, URL, ""))
    return strip(F.regexp_replace(without_urls, WIDE_SPACE, " "))


def remove_boilerplate(c, patterns: list[str] | None = None) -> Column:
    """Texts without the patterns. A plain phrase, with or without a comma, is only searched in texts that hold it."""
    out = F.lower(col(c))
    for pattern in BOILERPLATE if patterns is None else patterns:
        phrase, expression = pattern.removesuffix(",?"), f"(?i){pattern}"
        if re.fullmatch("[a-z ]+", phrase):
            out = _where_found(out, [phrase], lambda text, e=expression: F.regexp_replace(text, e, ""))
        else:
            out = F.regexp_replace(out, expression, "")
    return strip(out)


def title_case(c) -> Column:
    """Upper-case the first letter of every run of letters."""
    runs = F.regexp_extract_all(col(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    titled = F.transform(runs, _title_run)
    return F.array_join(titled, "")


def _title_run(run: Column) -> Column:
    # The capital of one letter may be several (sharp s): only the first of them stays upper case.
    capital = F.upper(run.substr(1, 1))
    tail = F.lower(capital.substr(F.lit(2), F.length(capital)))
    return F.concat(capital.substr(1, 1), tail, F.lower(run.substr(F.lit(2), F.length(run))))


def tokens(c, stop_words: list[str] | None = None) -> Column:
    """Word tokens of two or more characters, stop words removed."""
    stop = [w for w in (STOP_WORDS if stop_words is None else stop_words) if re.fullmatch(r"\w{2,}", w)]
    words = F.regexp_extract_all(col(c), F.lit(TOKEN), F.lit(1))
    return F.filter(words, lambda w: ~w.isin(stop)) if stop else words


def ngram_terms(token_array, ngrams: tuple[int, int] = (1, 2)) -> Column:
    """All n-grams (n from low to high) of a token array, repeats kept."""
    t = col(token_array)

    def windows(n: int) -> Column:
        starts = F.slice(t, 1, F.greatest(F.size(t) - F.lit(n - 1), F.lit(0)))
        return F.transform(starts, lambda w, i: F.concat_ws(" ", w, *[F.get(t, i + F.lit(k)) for k in range(1, n)]))

    parts = [t if n == 1 else windows(n) for n in range(ngrams[0], ngrams[1] + 1)]
    return F.concat(*parts) if len(parts) > 1 else parts[0]
