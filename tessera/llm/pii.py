"""Personal data: base patterns, and bootstrapped contextual extraction of what they miss.

Native: DataFrame functions only. Base matches seed a graph of instances, values of words, and
lexical patterns in which they stand: the two words to the left; and, for words with a form
(digits, symbols inside), the word to the left or to the right with the shape of the value,
and that shape alone. A pattern's confidence is the share of all its occurrences in the corpus
that are known identifiers, an instance's score is 1 if it is a seed and else that at least one
of its patterns is right. Rounds of scoring let good patterns raise new instances and those
raise new patterns, until nothing changes; then instances with a high score in patterns of high
confidence are personal data as well, of the kind of most seeds of their pattern.

Base matches are hidden for this: their characters become private ones, one for one, so that
each match is (part of) one word that tells its kind, and places in the text stay what they are.
Everything done to one text takes time by its length, whatever the number of its matches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, fresh, working, written

KINDS = ("email", "ip", "card", "phone")
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"

#: Private characters from here on: an ASCII character hidden by a kind is _HIDDEN + 128 * its rank + its code, and 512
#: more at the start of a match.
_HIDDEN, _START = 0xF0000, 512
_ANY_HIDDEN = rf"\x{{{_HIDDEN:x}}}-\x{{{_HIDDEN + 2 * _START - 1:x}}}"
_IS_HIDDEN = f"[{_ANY_HIDDEN}]"

#: Punctuation that is taken off both ends of a word.
AROUND = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’‚‹›…–—·•¿¡"
#: Words with a form: digits, an @, hidden characters, or symbols other than hyphens and apostrophes inside.
FORMED = rf"[0-9@{_ANY_HIDDEN}]|[\p{{L}}\p{{N}}][._%+:/()\[\]]+[\p{{L}}\p{{N}}]"
#: One word that a card number can be.
CARD_WORD = "[0-9](?:-?[0-9]){11,18}+"

#: Scores have settled when their sums move by less in a round.
SETTLED = 1e-4

_SPAN = "struct<start: int, rank: int, kind: string, end: int>"
_BLOCK = 128


def _set(ranges: tuple[str, ...], hidden_by: int) -> str:
    """The class of some ASCII characters, given as ranges of two, also as hidden by the first kinds."""
    shifts = [_HIDDEN + 128 * rank + start for rank in range(hidden_by) for start in (0, _START)]
    parts = (rf"\x{{{ord(r[0]) + s:x}}}-\x{{{ord(r[1]) + s:x}}}" for s in (0, *shifts) for r in ranges)
    return f"[{''.join(parts)}]"


def _patterns(hidden: bool = False) -> tuple[str, str, str, str]:
    """The patterns of KINDS, for a plain text or for one in which the kinds before each one have been hidden.

    Possessive repeats and start conditions keep every search linear; they don't change matches: a repeat never stops
    before a character of its own class, and a start within a run fails where the run's start did. \\G lets a match begin
    where the last one ended. A card is a whole run of digits with single spaces or hyphens between, of 12 to 19 digits.
    """
    local = "[A-Za-z0-9._%+-]"
    email = rf"(?:\G|(?<!{local})){local}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    d, dot = _set(("09",), 1 * hidden), _set(("..",), 1 * hidden)
    ip = rf"(?<!{d}){d}++{dot}{d}++{dot}{d}++{dot}{d}++"
    d, gap = _set(("09",), 2 * hidden), _set(("  ", "--"), 2 * hidden)
    card = rf"(?<!{d})(?<!{d}{gap}){d}(?:{gap}?{d}){{11,18}}+(?!{gap}?{d})"
    d, any_, plus = (_set(r, 3 * hidden) for r in (("09",), ("  ", "()", "..", "09", "--"), ("++",)))
    return email, ip, card, rf"{plus}{d}{any_}+{d}"


def _bind(value: Column, then: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), then)[0]


def _before(sizes: Column) -> Column:
    """For each of some numbers, the sum of those before it. In blocks, as an array that grows is copied each time."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size(sizes) - 1, F.lit(0)) / _BLOCK).cast("int")),
        lambda b: F.slice(sizes, b * _BLOCK + 1, F.lit(_BLOCK)),
    )

    def sums(numbers: Column) -> Column:
        return F.aggregate(
            numbers,
            F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("before")),
            lambda s, n: F.struct((s["sum"] + n).alias("sum"), F.array_append(s["before"], s["sum"]).alias("before")),
        )

    def whole(inner: Column) -> Column:
        starts = sums(F.transform(inner, lambda s: s["sum"]))["before"]
        return F.flatten(F.zip_with(inner, starts, lambda s, start: F.transform(s["before"], lambda n: n + start)))

    return _bind(F.transform(blocks, sums), whole)


def _located(text: Column, pattern: str) -> Column:
    """{start, end, found} of every match in order; code points, end exclusive."""

    def place(v: Column) -> Column:
        def put(before: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                start = F.get(before, i) + F.length(F.get(v["between"], i))
                return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("found"))

            return F.transform(v["found"], one)

        gaps = F.slice(v["between"], F.lit(1), F.size(v["found"]))
        return _bind(_before(F.zip_with(v["found"], gaps, lambda m, gap: F.length(m) + F.length(gap))), put)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _bind(F.struct(found.alias("found"), F.split(text, pattern, -1).alias("between")), place)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, k: Column) -> Column:
        d = F.ascii(F.substr(digits, n - k, F.lit(1))) - 48
        return total + F.when(k % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


_IP_LIKE, _CARD_LIKE = r"[0-9]\.[0-9]++\.[0-9]", "[0-9](?:[ -]?[0-9]){11}"


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return found.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")
    return _luhn(_digits(found)) if kind == "card" else F.length(_digits(found)).between(9, 15)


def _may(kind: str, text: Column) -> Column:
    """Whether a text can have matches: a cheap look before the search."""
    if kind in ("email", "phone"):
        return text.contains("@" if kind == "email" else "+")
    return text.rlike(_IP_LIKE if kind == "ip" else _CARD_LIKE)


def _may_any(text: Column) -> Column:
    return text.contains("@") | text.contains("+") | text.rlike(f"{_IP_LIKE}|{_CARD_LIKE}")


def base_spans(text: Column) -> Column:
    """All base matches of a text that is not null, as {start, rank, kind, end} by start, then kind."""

    def spans(rank: int, kind: str, pattern: str) -> Column:
        good = F.filter(_located(text, pattern), lambda e: _valid(kind, e["found"]))
        put = lambda e: F.struct(
            e["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), e["end"].alias("end")
        )
        all_ = F.transform(good, put).cast(f"array<{_SPAN}>")
        return F.when(_may(kind, text), all_).otherwise(F.array().cast(f"array<{_SPAN}>"))

    return F.array_sort(F.concat(*map(spans, range(4), KINDS, _patterns())))


#: Characters that matches have, and as hidden by a kind, at the start of a match or further on.
_SHOWN = "".join(map(chr, range(32, 127)))
_FIRST = [_SHOWN.translate({c: _HIDDEN + 128 * rank + _START + c for c in range(32, 127)}) for rank in range(4)]
_REST = [_SHOWN.translate({c: _HIDDEN + 128 * rank + c for c in range(32, 127)}) for rank in range(4)]
_RESERVED = "".join(map(chr, range(_HIDDEN, _HIDDEN + 2 * _START)))
_IS_REST = rf"\x{{{_HIDDEN:x}}}-\x{{{_HIDDEN + _START - 1:x}}}"


def _is_first(rank: int) -> str:
    low = _HIDDEN + _START + 128 * rank
    return rf"\x{{{low:x}}}-\x{{{low + 127:x}}}"


def _reveal(text: Column) -> Column:
    return F.translate(text, "".join(_FIRST + _REST), _SHOWN * 8)


def _hide(found: Column, rank: int) -> Column:
    """A match with its characters hidden; what another kind had hidden becomes part of it."""
    first = F.translate(F.substr(found, F.lit(1), F.lit(1)), _SHOWN, _FIRST[rank])
    rest = F.translate(F.substr(found, F.lit(2)), _SHOWN + "".join(_FIRST), _REST[rank] + "".join(_REST))
    return F.concat(first, rest)


def masked(text: Column) -> Column:
    """A text that is not null with all base matches hidden, character by character. Overlapping ones become one, of the
    kind of the first. Characters that a text has of those that hide others become U+FFFD."""
    plain = F.when(text.rlike(_IS_HIDDEN), F.translate(text, _RESERVED, "\ufffd" * len(_RESERVED))).otherwise(text)

    def hide(t: Column, rank: int, kind: str, pattern: str) -> Column:
        pieces = F.zip_with(
            F.split(t, pattern, -1),
            F.regexp_extract_all(t, F.lit(pattern), F.lit(0)),
            lambda gap, m: F.concat(gap, F.coalesce(F.when(_valid(kind, _reveal(m)), _hide(m, rank)).otherwise(m), F.lit(""))),
        )
        # what a kind hid may be part of the next one's matches, so those are told from the plain text
        return F.when(_may(kind, text), F.array_join(pieces, "")).otherwise(t)

    steps = zip(range(4), KINDS, _patterns(hidden=True), strict=True)
    out = reduce(lambda t, step: _bind(t, lambda x: hide(x, *step)), steps, plain)
    return F.when(_may_any(text), out).otherwise(plain)


def _plain(text: Column) -> Column:
    """A text as contexts have it: lower case, every digit 0, every match a sign of its kind."""
    out = text
    for rank in range(4):
        out = F.regexp_replace(out, f"[{_is_first(rank)}][{_IS_REST}]*", chr(_HIDDEN + _START + 128 * rank))
    out = F.when(text.rlike(_IS_HIDDEN), out).otherwise(text)
    return F.when(text.rlike("[1-9]"), F.regexp_replace(F.lower(out), "[1-9]", "0")).otherwise(F.lower(out))


def _words(text: Column) -> Column:
    return F.split(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")


def _shape(word: Column) -> Column:
    """The template of a value: each digit 0, letters of any number a, other characters as they are."""
    shown = F.when(word.rlike(f"[{_ANY_HIDDEN}]"), F.translate(_reveal(word), " ", "_")).otherwise(word)
    return F.regexp_replace(F.regexp_replace(shown, "[0-9]", "0"), r"\p{L}+", "a")


def _places(texts: DataFrame, *keep: str) -> DataFrame:
    """(*keep, at, a, b, word, c) of every word of texts (m, *keep): its number in the text, the word without punctuation
    around it (empty if it has nothing else), and two words before and one after it as contexts have them, null beyond the
    text. Words are built before texts are exploded, so a word's row doesn't carry its text.
    """
    rows = texts.select(*keep, _words(_plain(F.col("m"))).alias("w"), _words(F.col("m")).alias("v"))
    none = F.lit(None).cast("string")
    cut = lambda start, less: F.slice("w", F.lit(start), F.greatest(F.size("w") - less, F.lit(0)))
    places = F.arrays_zip(
        F.concat(F.array(none, none), cut(1, 2)).alias("a"),
        F.concat(F.array(none), cut(1, 1)).alias("b"),
        F.col("v").alias("word"),
        F.concat(cut(2, 1), F.array(none)).alias("c"),
    )
    rows = rows.select(*keep, F.posexplode(places).alias("at", "t")).filter("t.word IS NOT NULL")
    return rows.select(*keep, "at", "t.a", "t.b", F.btrim("t.word", F.lit(AROUND)).alias("word"), "t.c")


def _in_each(rows: DataFrame) -> DataFrame:
    """rows of words with a form (a, b, word, c, ...) once for each pattern that the word stands in, as pattern: "2 x y", the
    two words before; "1 y shape"; "3 shape z"; "= shape"."""
    rows = rows.withColumn("shape", _shape(F.col("word")))
    patterns = F.array(
        F.concat(F.lit("2 "), "a", F.lit(" "), "b"),
        F.concat(F.lit("1 "), "b", F.lit(" "), "shape"),
        F.concat(F.lit("3 "), "shape", F.lit(" "), "c"),
        F.concat(F.lit("= "), "shape"),
    )
    return rows.withColumn("pattern", F.explode(F.array_compact(patterns))).drop("a", "b", "c", "shape")


def _after_two(rows: DataFrame) -> DataFrame:
    """rows of _places with the one pattern that words without a form stand in."""
    return rows.withColumn("pattern", F.concat(F.lit("2 "), "a", F.lit(" "), "b")).drop("a", "b", "c")


#: A base match in a masked text.
_RUN = "[" + "".join(map(_is_first, range(4))) + f"][{_IS_REST}]*"


def _counted(rows: DataFrame) -> DataFrame:
    """(pattern, value, n, rank) of rows (pattern, word): rank is that of a base match, whose value is all of it."""
    run = F.when(F.col("word").rlike(_IS_HIDDEN), F.regexp_extract("word", _RUN, 0))
    rank = F.floor((F.ascii(run) - (_HIDDEN + _START)) / 128).cast("int")
    value = F.coalesce(_reveal(run), "word").alias("value")
    return rows.select("pattern", value, rank.alias("rank")).groupBy("pattern", "value").agg(
        F.count("*").alias("n"), F.max("rank").alias("rank")
    )


def _formed(texts: DataFrame) -> DataFrame:
    """All words with a form of texts (m, sha), in each of their patterns: (sha, at, word, pattern). They are few among
    all words, so this is written once and read in every round."""
    some = texts.filter(F.col("text").rlike(FORMED))  # base matches have digits or an @
    return written(_in_each(_places(some, "sha").filter(F.col("word").rlike(FORMED))), "formed")


def _seeds(formed: DataFrame) -> DataFrame:
    """(pattern, value, n, rank) of base matches and of words that look like one but are none where they stand, as card
    numbers beside another number (rank null)."""
    return _counted(formed.filter(F.col("word").rlike(_IS_HIDDEN) | F.col("word").rlike(f"^{CARD_WORD}$")))


def _plain_words(texts: DataFrame, *keep: str) -> DataFrame:
    """(*keep, at, word, pattern) of the words without a form of texts (m, *keep)."""
    rows = _after_two(_places(texts, *keep))
    return rows.filter(F.col("pattern").isNotNull() & ~F.col("word").rlike(FORMED))


def _of_values(texts: DataFrame, formed: DataFrame, values: DataFrame) -> DataFrame:
    """(pattern, value, n, rank) of all words that hold one of values and are no part of base matches."""
    words = values.select(F.col("value").alias("word"))
    found = formed.join(words, "word").select("pattern", "word")
    plain = words.filter(~F.col("word").rlike(FORMED))
    if not plain.isEmpty():
        found = found.unionByName(_plain_words(texts).join(plain, "word").select("pattern", "word"))
    return _counted(found)


def in_patterns(texts: DataFrame, formed: DataFrame, patterns: DataFrame) -> DataFrame:
    """(sha, at, pattern, word) of all words of texts that stand in patterns."""
    # whatever the number of patterns: Spark broadcasts them below its own threshold, and else sorts
    found = formed.join(patterns.select("pattern"), "pattern")
    two = patterns.select("pattern").filter(F.col("pattern").startswith("2 "))
    if two.isEmpty():
        return found
    return found.unionByName(_plain_words(texts, "sha").join(two, "pattern").select(found.columns))


def _totals(places: DataFrame) -> DataFrame:
    """(pattern, total): how often each pattern has a word."""
    return written(places.groupBy("pattern").agg(F.count("*").alias("total")), "totals")


def _also(done: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if done is None else done.unionByName(more)


def _other(rows: DataFrame, done: DataFrame | None, key: str, name: str) -> DataFrame:
    """The distinct keys of rows that done doesn't have."""
    keys = rows.select(key).distinct()
    return written(keys if done is None else keys.join(done.select(key).distinct(), key, "left_anti"), name)


def learn(
    texts: DataFrame, *, support: int = 3, confidence: float = 0.8, score: float = 0.9, rounds: int = 1000
) -> DataFrame | None:
    """(sha, at, rank) of the words that are instances discovered, by number in the text of that digest; None without any.

    texts: (text, m), with m as masked gives it. A pattern counts with support distinct known values and the given
    confidence at least. Candidates are the words with a form and all words that stand in the two-word context of a base
    match. Every text is read whole, for them and for the number of words that each pattern has. A known value that stands
    in a good pattern is found wherever the base patterns miss it. Scoring goes on until patterns, instances and scores
    have settled; rounds is a guard that raises.
    """
    with working(texts.sparkSession) as keep:
        found = _learnt(texts, support, confidence, score, rounds)
        return None if found is None else keep(found, "found")


def _learnt(texts: DataFrame, support: int, confidence: float, score: float, rounds: int) -> DataFrame | None:
    named = texts.withColumn("sha", F.sha2("text", 256))
    every = _formed(named)
    pairs = written(_seeds(every), "pairs")
    begun = pairs.filter("rank IS NOT NULL")
    seeds = written(begun.select("value").distinct(), "seeds")
    if seeds.isEmpty():
        return None
    seeded = begun.select("pattern").distinct()
    formed = F.col("value").rlike(FORMED)
    some = named.filter(F.col("text").rlike(r"@|\+[0-9]"))

    def candidates(rows: DataFrame) -> DataFrame:
        return rows.filter(formed).unionByName(rows.filter(~formed & (F.col("value") != "")).join(seeded, "pattern", "left_semi"))

    sizes: dict[str, int] = {}

    def grew(name: str, rows: DataFrame) -> bool:
        """Scores only ever grow, and the sets with them: one of the same size is the same."""
        before, sizes[name] = sizes.get(name, 0), rows.count()
        return sizes[name] > before

    edges = written(pairs.join(seeds, "value"), "edges")  # all occurrences of known values
    given = seeds.withColumns({"score": F.lit(1.0), "as": F.lit(None).cast("int")})
    kind = F.coalesce(F.mode("rank", True), F.mode("as", True))  # of most seeds, or else of most instances raised
    scores = given
    lower = totals = held = reached = good = None
    was = None
    for done in range(rounds + 1):
        if done == rounds:
            raise RuntimeError(f"pattern and instance scores still change after {rounds} rounds")
        known = (
            edges.join(scores, "value")
            .groupBy("pattern")
            .agg(F.count("*").alias("known"), F.sum(F.col("n") * F.col("score")).alias("mass"), kind.alias("kind"))
            .filter(F.col("known") >= support)
        )
        known = written(known, "known")
        if grew("known", known):
            unbounded = _other(known, lower, "pattern", "unbounded")
            # words with a form are counted in all texts at once, the others in some first
            lower = _also(lower, _totals(in_patterns(some, every, unbounded)))
        # some texts hold no more than all: patterns that fall below the confidence in them fall below it at all
        if lower is None:
            return None
        enough = F.col("mass") >= F.coalesce("total", F.lit(0)) * confidence
        likely = known.join(lower, "pattern", "left").filter(enough).select(known.columns)
        if grew("likely", likely):
            # such a pattern has few words beyond the known ones in those texts, and so not many in all
            new = written(in_patterns(named, every, _other(likely, totals, "pattern", "uncounted")), "places")
            totals = _also(totals, _totals(new))
            unseen = new.filter(~F.col("word").rlike(_IS_HIDDEN)).withColumnRenamed("word", "value")
            held = _also(held, written(candidates(unseen), "held"))
        if totals is None:
            return None
        conf = (F.col("mass") / F.col("total")).alias("conf")
        good = likely.join(totals, "pattern").select("pattern", "kind", conf).filter(F.col("conf") >= confidence)
        sure = good.agg(F.count("*"), F.sum("conf")).first()
        if not sure[0]:
            return None
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("conf"), F.lit(1e-6)))))
        unknown = held.join(seeds, "value", "left_anti").select("pattern", "value").distinct()
        raised = unknown.join(good, "pattern").groupBy("value").agg((1 - doubt).alias("score"), F.mode("kind", True).alias("as"))
        raised = written(raised, "raised")
        found = raised.agg(F.count("*"), F.sum("score")).first()
        if found[0] > sizes.get("raised", 0):
            sizes["raised"] = found[0]
            more = _other(raised, reached, "value", "reached")
            reached = _also(reached, more)
            places = written(_of_values(texts, every, more), "values")
            edges = edges.unionByName(written(candidates(places), "edges"))
        scores = given.unionByName(raised)
        now = sure + found
        if was and all(abs((x or 0) - (y or 0)) < SETTLED for x, y in zip(was, now, strict=True)):
            break
        was = now
    new = held.join(scores.filter(F.col("score") >= score).select("value"), "value").join(good, "pattern")
    best = F.max_by("kind", F.struct("conf", "kind")).alias("rank")
    found = written(new.groupBy("sha", "at").agg(best).select("sha", "at", F.coalesce("rank", F.lit(0)).alias("rank")), "found")
    return None if found.isEmpty() else found


def _placed(m: Column, found: Column) -> Column:
    """Spans of found words {at, rank} of a masked text."""
    kinds = F.array(*map(F.lit, KINDS))

    def place(words: Column) -> Column:
        def one(f: Column) -> Column:
            word = F.get(words, f["at"])
            start = word["end"] - F.length(F.ltrim(word["found"], F.lit(AROUND)))
            end = word["start"] + F.length(F.rtrim(word["found"], F.lit(AROUND)))
            return F.struct(
                start.alias("start"), f["rank"].cast("int").alias("rank"), F.get(kinds, f["rank"]).alias("kind"), end.alias("end")
            )

        return F.transform(found, one)

    return _bind(_located(m, WORD), place).cast(f"array<{_SPAN}>")


def _hidden_words(m: Column, found: Column) -> Column:
    """A masked text with the found words {at, rank}, in order, hidden as well."""

    def put(v: Column) -> Column:
        # for each word its rank or null: nulls up to each found word, then its rank
        ranks = F.flatten(
            F.transform(
                found,
                lambda f, i: F.concat(
                    F.array_repeat(F.lit(None).cast("int"), f["at"] - F.when(i > 0, F.get(found["at"], i - 1) + 1).otherwise(0)),
                    F.array(f["rank"].cast("int")),
                ),
            )
        )

        def hide(word: Column, rank: Column) -> Column:
            core = F.btrim(word, F.lit(AROUND))
            lead = F.substr(word, F.lit(1), F.length(word) - F.length(F.ltrim(word, F.lit(AROUND))))
            tail = F.substr(word, F.length(F.rtrim(word, F.lit(AROUND))) + 1)
            out = word
            for k in range(4):
                out = F.when(rank == k, F.concat(lead, _hide(core, k), tail)).otherwise(out)
            return out

        words = F.zip_with(v["words"], ranks, lambda w, r: F.when(r.isNull(), w).otherwise(hide(w, r)))
        pieces = _bind(words, lambda w: F.zip_with(v["gaps"], w, lambda gap, x: F.concat(gap, F.coalesce(x, F.lit("")))))
        return F.array_join(pieces, "")

    words = F.regexp_extract_all(m, F.lit(WORD), F.lit(0))
    return _bind(F.struct(F.split(m, WORD, -1).alias("gaps"), words.alias("words")), put)


def _with_found(docs: DataFrame, text: Column, name: str, **options) -> DataFrame:
    """docs with one more column: the words {at, rank} discovered in their texts, in order, or null."""
    texts = docs.select(text.alias("text"))
    found = learn(texts.withColumn("m", masked(F.col("text"))), **options)
    if found is None:
        return docs.withColumn(name, F.lit(None).cast("array<struct<at: int, rank: int>>"))
    words = F.array_sort(F.collect_list(F.struct("at", "rank")))  # of one text
    more = written(found.groupBy("sha").agg(words.alias("more")), "more")
    (sha,) = fresh(docs, f"{name}_sha")
    keyed = docs.withColumn(sha, F.when(text != "", F.sha2(text, 256)))
    return keyed.join(more.toDF(f"{sha}_", name), F.col(sha) == F.col(f"{sha}_"), "left").drop(sha, f"{sha}_")


def _listed(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of docs: id, n_email, n_ip, n_card, n_phone, base_sha256, spans (options: see learn).

    A null text is empty and has none; texts of any length are read whole; repeated rows and null ids get their own
    row; an empty table gives none. Of spans that start at the same place, the kind listed first stands first.
    """
    docs = docs.select(id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base, spans, more = fresh(docs, "base", "spans", "more")
    out = _with_found(docs, text, more, **options).withColumn(base, base_spans(text))
    every = F.array_sort(F.concat(F.col(base), _placed(masked(text), F.col(more))))
    out = out.withColumn(spans, F.when(F.col(more).isNull(), F.col(base)).otherwise(every))
    ranks = F.transform(base, lambda s: s["rank"])
    counts = [
        (F.size(ranks) - F.size(F.array_remove(ranks, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)
    ]
    return out.select(
        F.col(id_col), *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(spans).alias("spans")
    )


def redact(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs, columns unchanged, with [EMAIL], [IP], [CARD] or [PHONE] for each span of their texts (options: see learn).

    Overlapping spans are one, named after the first. Texts without spans stay as they are, null too; a column n_chars
    follows a text that changes. In a text that changes, private characters from U+F0000 to U+F03FF become U+FFFD.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    more, m, name = fresh(docs, "more", "masked_text", "redacted")
    out = _with_found(docs, text, more, **options).withColumn(m, masked(text))
    out = out.withColumn(m, F.when(F.col(more).isNull(), F.col(m)).otherwise(_hidden_words(F.col(m), F.col(more))))
    clean = F.col(m)
    for rank, kind in enumerate(KINDS):
        clean = F.regexp_replace(clean, f"[{_is_first(rank)}][{_IS_REST}]*", f"[{kind.upper()}]")
    out = out.withColumn(name, F.when(F.col(m).rlike(_IS_HIDDEN), clean))
    new = {text_col: F.coalesce(name, text_col)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.coalesce(F.length(name).cast(kind), "n_chars")
    return out.withColumns(new).select(*docs.columns)
