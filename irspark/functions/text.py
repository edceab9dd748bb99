"""Tokens, case folding, stop words and Russian stems as Columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from irspark.functions.binding import let

# Words, numbers and underscores of any script.
WORD = r"[\p{L}\p{N}_]+"

# Social-media text: urls, e-mail addresses, emoticons, handles, hashtags, words with inner
# apostrophes or dashes, numbers, runs of dots, and every other visible sign on its own.
SOCIAL = (
    r"https?://[^\s<>]+|www\.[^\s<>]+"
    r"|[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+"
    r"|[<>]?[:;=8][\-o*']?[()\[\]dDpP/:{}@|\\]"
    r"|@[\p{L}\p{N}_]+|#+[\p{L}\p{N}_]+[\p{L}\p{N}_'\-]*"
    r"|[\p{L}](?:[\p{L}'\-_]+[\p{L}])|[+\-]?\p{N}+(?:[,/.:\-]\p{N}+[+\-]?)?|[\p{L}\p{N}_]+"
    r"|\.(?:\s*\.)+|[^\s\p{L}\p{N}_]"
)
PATTERNS = {"words": WORD, "social": SOCIAL}


def tokenize(text: Column, mode: str = "words") -> Column:
    """All tokens in order; `mode` picks the token pattern."""
    if mode not in PATTERNS:
        raise ValueError(f"unknown token mode {mode!r}")
    return F.regexp_extract_all(text, F.lit(PATTERNS[mode]), F.lit(0))


def fold_tokens(text: Column, mode: str = "words") -> Column:
    """Tokens of the lower-cased text."""
    return tokenize(F.lower(text), mode)


def remove_stop_words(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Drop stop words, keeping order and repetition of the rest."""
    if not stop_words:
        return tokens
    words = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(words))


def stop_words(spark: SparkSession, language: str = "russian") -> list[str]:
    """Stop list that ships with Spark ML."""
    from pyspark.ml.feature import StopWordsRemover

    if spark.sparkContext._jvm is None:
        raise RuntimeError("no active Spark session")
    return StopWordsRemover.loadDefaultStopWords(language)


# Endings of the published Snowball stemmer for Russian, in its order of steps.
VOWELS = "аеиоуыэюя"
GERUND_AFTER_A = "вшись|вши|в"
GERUND = "ившись|ывшись|ивши|ывши|ив|ыв"
REFLEXIVE = "ся|сь"
ADJECTIVE = (
    "ими|ыми|его|ого|ему|ому|ее|ие|ые|ое|ей|ий|ый|ой|ем|им|ым|ом|их|ых|ую|юю|ая|яя|ою|ею"
)
PARTICIPLE_AFTER_A = "ем|нн|вш|ющ|щ"
PARTICIPLE = "ивш|ывш|ующ"
VERB_AFTER_A = "ете|йте|ешь|нно|ла|на|ли|ем|ло|но|ет|ют|ны|ть|й|л|н"
VERB = (
    "ейте|уйте|ила|ыла|ена|ите|или|ыли|ило|ыло|ено|ует|уют|ены|ить|ыть|ишь|"
    "ей|уй|ил|ыл|им|ым|ен|ят|ит|ыт|ую|ю"
)
NOUN = (
    "иями|иях|иям|ией|ием|ями|ами|ев|ов|ие|ье|еи|ии|ей|ой|ий|ям|ем|ам|ом|ах|ях|"
    "ию|ью|ия|ья|а|е|и|й|о|у|ы|ь|ю|я"
)
DERIVATIONAL = "ость|ост"


def _drop(word: Column, pattern: str, keep: str = "") -> Column:
    return F.regexp_replace(word, pattern, keep)


def _either(after_a: str, free: str) -> str:
    """Pattern of an ending: some need а or я before them, which stays as the first group."""
    return f"(?:([ая])(?:{after_a})|(?:{free}))$"


def _first_change(word: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """Apply the first replacement that changes the word."""
    (pattern, keep), *rest = patterns
    if not rest:
        return _drop(word, pattern, keep)
    return let(
        _drop(word, pattern, keep),
        lambda new: F.when(new != word, new).otherwise(_first_change(word, rest)),
    )


def _inflection(tail: Column) -> Column:
    """First step: a gerund ending, or a reflexive ending and then one of three kinds."""
    kinds = [
        (f"(?:(?:([ая])(?:{PARTICIPLE_AFTER_A}))|(?:{PARTICIPLE}))(?:{ADJECTIVE})$", "$1"),
        (f"(?:{ADJECTIVE})$", ""),
        (_either(VERB_AFTER_A, VERB), "$1"),
        (f"(?:{NOUN})$", ""),
    ]
    return let(
        _drop(tail, _either(GERUND_AFTER_A, GERUND), "$1"),
        lambda new: F.when(new != tail, new).otherwise(
            let(_drop(tail, f"(?:{REFLEXIVE})$"), lambda plain: _first_change(plain, kinds))
        ),
    )


def _cut(word: Column, count: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - count)


def _derivation(head: Column, tail: Column) -> Column:
    """Third step: the ending must lie behind the second vowel-consonant border of the word."""
    border = f"[^{VOWELS}]*[{VOWELS}]+[^{VOWELS}]"
    ending = f"(?:{DERIVATIONAL})$"
    far = F.concat(head, tail).rlike(f"^{border}{border}.*{ending}")
    has = tail.endswith("ост") | tail.endswith("ость")
    return F.when(has, F.when(far, _drop(tail, ending)).otherwise(tail)).otherwise(tail)


def _single_n(tail: Column) -> Column:
    return F.when(tail.endswith("нн"), _cut(tail, 1)).otherwise(tail)


def _tidy(tail: Column) -> Column:
    """Last step: superlative, double н, soft sign."""
    return (
        F.when(tail.endswith("ейше"), let(_cut(tail, 4), _single_n))
        .when(tail.endswith("ейш"), let(_cut(tail, 3), _single_n))
        .when(tail.endswith("нн"), _cut(tail, 1))
        .when(tail.endswith("ь"), _cut(tail, 1))
        .otherwise(tail)
    )


def _stem_word(word: Column) -> Column:
    def from_head(head: Column) -> Column:
        rest = F.substring(word, F.length(head) + 1, F.length(word))
        step1 = let(rest, _inflection)
        step2 = let(step1, lambda t: F.when(t.endswith("и"), _cut(t, 1)).otherwise(t))
        step3 = let(step2, lambda t: _derivation(head, t))
        return F.when(head == "", word).otherwise(F.concat(head, let(step3, _tidy)))

    return let(F.regexp_extract(word, f"^([^{VOWELS}]*[{VOWELS}])", 1), from_head)


def stem_russian(token: Column) -> Column:
    """Snowball stem of one token; tokens without Cyrillic letters stay as they are."""
    folded = F.translate(F.lower(token), "ё", "е")
    return F.when(token.rlike(r"\p{IsCyrillic}"), let(folded, _stem_word)).otherwise(token)


def normalize_text(text: Column, mode: str = "words") -> Column:
    """Stem every token and join them by a blank."""
    return F.array_join(F.transform(tokenize(text, mode), stem_russian), " ")
