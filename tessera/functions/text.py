"""Text normalization, tokenization and label parsing as column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of words: letters, numbers and underscore, in any script.
_WORD = r"\p{L}\p{N}_"
#: White space in any script.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
_QUOTES = ("‘’“”", "''\"\"")

# Phrases for "percent" by language.
PERCENT = {
    "it": r"per\s+cento",
    "en": r"per\s+cent\b|percent\b",
    "fr": r"pour\s+cent",
    "de": r"\bprozent\b",
    "es": r"por\s+ciento",
    "pt": r"por\s+cento",
    "nl": r"\bprocent\b",
}

# Language names and their codes.
LANGUAGE_NAMES = {
    "italian": "it",
    "english": "en",
    "french": "fr",
    "spanish": "es",
    "portuguese": "pt",
    "german": "de",
    "dutch": "nl",
    "russian": "ru",
    "chinese": "zh",
    "japanese": "ja",
    "korean": "ko",
}
# Two-letter codes that speech models know.
LANGUAGE_CODES = (
    "af", "am", "ar", "as", "az", "ba", "be", "bg", "bn", "bo", "br", "bs", "ca", "cs", "cy", "da", "de", "el", "en",
    "es", "et", "eu", "fa", "fi", "fo", "fr", "gl", "gu", "ha", "he", "hi", "hr", "ht", "hu", "hy", "id", "is", "it",
    "ja", "jw", "ka", "kk", "km", "kn", "ko", "la", "lb", "ln", "lo", "lt", "lv", "mg", "mi", "mk", "ml", "mn", "mr",
    "ms", "mt", "my", "ne", "nl", "nn", "no", "oc", "pa", "pl", "ps", "pt", "ro", "ru", "sa", "sd", "si", "sk", "sl",
    "sn", "so", "sq", "sr", "su", "sv", "sw", "ta", "te", "tg", "th", "tk", "tl", "tr", "tt", "uk", "ur", "uz", "vi",
    "yi", "yo", "zh",
)
# Names of automatic detection, which is refused.
AUTOMATIC = ("auto", "autodetect", "auto-detect", "auto detect")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def words(c: Column) -> Column:
    """Words between white space; none in an empty text."""
    return F.filter(F.split(c, f"{SPACE}+"), lambda w: w != "")


def normalize_basic(c: Column) -> Column:
    """Straight quotes, lower case, punctuation to spaces, single spaces."""
    return collapse(F.regexp_replace(F.lower(F.translate(c, *_QUOTES)), f"[^{_WORD}\\s]", " "))


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, str]:
    """Characters whose compatibility decomposition holds one ASCII character, those characters, and the characters whose
    decomposition holds several."""
    one, to, several = [], [], []
    for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x110000))):
        plain = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode() if unicodedata.decomposition(c) else ""
        if len(plain) == 1:
            one.append(c)
            to.append(plain)
        elif plain:
            several.append(c)
    return "".join(one), "".join(to), "".join(several)


def _fold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


def fold_ascii(c: Column, seen: Column | None = None) -> Column:
    """Compatibility decomposition without what isn't ASCII. Spark has no such function.

    Decomposition goes character by character, so a table does it; only texts with a character that becomes several (a
    ligature, a fraction) go to Python, for others that column is null. Both look characters up by translate: a class of
    hundreds of characters in a regular expression is tried range by range at every character.

    seen: a column that has all characters of c that aren't ASCII, where it costs less than c.
    """
    one, to, several = _folds()
    seen = c if seen is None else seen
    ascii_only = F.octet_length(seen) == F.length(seen)
    rare = ~ascii_only & (F.length(F.translate(seen, several, "")) < F.length(seen))
    slow = F.pandas_udf(_fold, "string")(F.when(rare, c))
    return F.when(ascii_only, c).otherwise(
        F.coalesce(slow, F.regexp_replace(F.translate(c, one, to), r"[^\x00-\x7F]+", ""))
    )


def _join_digits(c: Column) -> Column:
    """12:00 is 12, 1.000 is 1000."""
    # the marks come first and what stands before them after, as most characters are no mark
    whole = F.regexp_replace(c, r"(?=[0-9])(?<![\p{L}\p{N}_])([0-9]+)[.,:;](00)(?![\p{L}\p{N}_])", "$1")
    return F.regexp_replace(whole, "[.,](?<=[0-9].)(?=[0-9])", "")


def normalize_full(c: Column, lang: Column, spell: tuple = ()) -> Column:
    """Normalization for languages with a percent phrase; others are normalized as normalize_basic does.

    spell: functions (column, language) -> column that turn digits into words and back; none by default, as both need
    a library for each language.
    """
    text = F.translate(c, *_QUOTES)
    percent = reduce(
        lambda out, item: F.when(lang == item[0], F.regexp_replace(text, f"(?i){item[1]}", "%")).otherwise(out),
        PERCENT.items(),
        text,
    )
    spelt = reduce(lambda out, f: f(out, lang), spell, _join_digits(percent))
    # without spell, what isn't ASCII is what was there, so the text itself is looked through
    plain = _join_digits(F.lower(fold_ascii(spelt, None if spell else c)))
    full = F.trim(F.regexp_replace(plain, "[^a-z0-9_]+", " "))
    return F.when(lang.isin(*PERCENT), full).otherwise(normalize_basic(c))


def language_code(name: Column) -> Column:
    """The code of a language name or two-letter code; null for automatic detection and what is unknown."""
    lang = F.lower(strip(name))
    by_name = F.create_map(*(F.lit(x) for pair in LANGUAGE_NAMES.items() for x in pair))
    code = F.coalesce(F.try_element_at(by_name, lang), F.when(lang.isin(*LANGUAGE_CODES), lang))
    return F.when(~lang.isin(*AUTOMATIC), code)


def checked_language_code(name: Column) -> Column:
    """As language_code, but raises where there is none."""
    code = language_code(name)
    message = F.concat(F.lit("language not supported: "), F.coalesce(name, F.lit("null")))
    return F.when(code.isNotNull(), code).otherwise(F.raise_error(message).cast("string"))


def phonemes_pitch(c: Column) -> Column:
    """Lower case and single spaces, with stress and length marks."""
    return collapse(F.lower(c))


def phonemes(c: Column) -> Column:
    """As phonemes_pitch, without stress, length and syllable marks."""
    return phonemes_pitch(F.translate(c, "ˈˌːˑ̩", ""))


def zip_phonemes(text: Column, chunks: Column) -> Column:
    """Each word with its chunk of phonemes (between U+001F); missing chunks are empty, chunks beyond are dropped."""
    # both arrays are arguments, so made once a row: in the lambda's body they would be made again for each word
    p = F.coalesce(F.split(chunks, "\x1f"), F.array().cast("array<string>"))
    pair = lambda word, chunk: F.struct(word.alias("word"), F.coalesce(chunk, F.lit("")).alias("phonemes"))
    return F.filter(F.zip_with(words(text), p, pair), lambda e: e["word"].isNotNull())


def flat_phonemes(zipped: Column) -> Column:
    return phonemes(F.array_join(F.filter(F.transform(zipped, lambda e: e["phonemes"]), lambda p: p != ""), " "))


def parse_reason(reason: Column) -> Column:
    """{metric, value, threshold} of 'wer=0.4 > 0.2'; ('wer', 0, 0) for anything else."""
    # Fixed value: the format of reasons.
    shape = r"^(wer|per)=([0-9.]+)\s*>\s*([0-9.]+)$"
    value, limit = (F.regexp_extract(reason, shape, k).try_cast("double") for k in (2, 3))
    fits = value.isNotNull() & limit.isNotNull()
    return F.struct(
        F.when(fits, F.regexp_extract(reason, shape, 1)).otherwise("wer").alias("metric"),
        F.when(fits, value).otherwise(0.0).alias("value"),
        F.when(fits, limit).otherwise(0.0).alias("threshold"),
    )


def diff_tokens(c: Column) -> Column:
    """Words, with inner apostrophes, and single marks."""
    return F.regexp_extract_all(c, F.lit(f"[{_WORD}]+(?:['’][{_WORD}]+)*|[^{_WORD}\\s]"), F.lit(0))


def bucket_path(idx: Column, per_dir: int, max_idx: Column) -> Column:
    """Where a clip is published: wavs/<first>-<last of its bucket>/<idx>.wav, flat if per_dir is 0 or less."""
    name = F.format_string("%06d.wav", idx)
    if per_dir <= 0:
        return F.concat(F.lit("wavs/"), name)
    first = F.floor(idx / per_dir) * per_dir
    last = F.least(first + per_dir - 1, max_idx)
    return F.concat(F.format_string("wavs/%06d-%06d/", first, last), name)


def hhmmss(seconds: Column) -> Column:
    """HH:MM:SS.mmm of a duration, rounded to milliseconds; negative ones are 0."""
    ms = F.round(F.greatest(seconds, F.lit(0.0)) * 1000).cast("long")
    part = lambda size, of: F.floor(ms / size) % of
    return F.format_string(
        "%02d:%02d:%02d.%03d", F.floor(ms / 3600000), part(60000, 60), part(1000, 60), ms % 1000
    )


def seconds_label(seconds: Column) -> Column:
    """A duration as it is shown beside a clip: two places and s; empty where it is unknown."""
    return F.when(seconds.isNotNull(), F.format_string("%.2fs", seconds)).otherwise("")


def local_time(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def utc_now() -> Column:
    """The time of the query in UTC, to seconds."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def same_name(a: Column, b: Column) -> Column:
    """Whether two names agree whatever their case."""
    return F.lower(a) == F.lower(b)


def index_of(path: Column) -> Column:
    """The number that a clip's file name stands for; null if it is none."""
    return F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1).try_cast("int")


def index_list(c: Column) -> Column:
    """'7, 13' as numbers; blanks are dropped, anything else raises."""
    return F.transform(F.filter(F.transform(F.split(c, ","), F.trim), lambda s: s != ""), lambda s: s.cast("int"))


def fingerprint(*parts: Column) -> Column:
    """SHA-256 over the parts, each closed by a mark, null as empty."""
    return F.sha2(F.concat(*(F.concat(F.coalesce(p.cast("string"), F.lit("")), F.lit("\x1f")) for p in parts)), 256)
