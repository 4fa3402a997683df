from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
digits = lambda s: re.sub("[^0-9]", "", s)


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


RULES = (
    ("email", EMAIL, lambda s: True),
    ("ip", IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", CARD, lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
    ("phone", PHONE, lambda s: 9 <= len(digits(s)) <= 15),
)


def brute(text):
    return sorted(
        (m.start(), rank, kind, m.end())
        for rank, (kind, shape, ok) in enumerate(RULES)
        for m in shape.finditer(text or "")
        if ok(m.group())
    )


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def texts():
    rng = random.Random(2)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randrange(n)))
    out = [make("0123456789  --..@@ab+()é\U0001f600%_", 120) for _ in range(300)] + [make("0123456789 -", 60) for _ in range(300)]
    out += [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "0.0.0.0", "256.1.1.1", "007.1.1.001", "4111 1111-1111 1111", "4111111111111112"]
    # long runs that a careless search would take squared time or deep recursion for
    out += ["a@" + "b." * 20000 + "c", "1" * 30000, "1 " * 3000, "1." * 3000, "a" * 60000, "+1" + " 2" * 3000]
    return out


def test_base_spans_as_by_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], "doc_id long, text string, base string, spans int")
    got = pii.personal_data(df).collect()
    assert len(got) == len(rows)
    by_id = dict(rows)
    for r in got:
        want = brute(by_id[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in want) for k, *_ in RULES]
        assert set(listed(want).split(",")) <= set(r.spans.split(","))


def corpus(spark):
    rng = random.Random(4)
    filler = lambda: " ".join(rng.choice(["one", "of", "the", "many", "things", "that", "people", "said"]) for _ in range(25))
    rows = [(k, f"{filler()} please call +1 (202) 555-{k:04d} today") for k in range(40)]
    rows = [(k, t.replace("please call", "please call at")) for k, t in rows]
    rows += [(100 + k, f"{filler()} please call at (555-01{k:02d}), thanks") for k in range(3)]
    rows += [(200 + k, f"{filler()} of the {1900 + k} {filler()}") for k in range(30)]
    rows += [(300, f"{filler()} mail a.b@c.de now"), (None, "please call at 555-0177"), (None, None), (301, "")]
    return rows, spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")


def test_contexts_find_what_base_patterns_miss(spark):
    rows, df = corpus(spark)
    got = {r.doc_id: r for r in pii.personal_data(df).collect() if r.doc_id is not None}
    for k in range(3):
        text = dict(rows)[100 + k]
        at = text.index("555-")
        assert got[100 + k].spans == f"phone:{at}:{at + 8}" and got[100 + k].n_phone == 0
    assert all(got[200 + k].spans == "" for k in range(30))


def test_redaction_covers_all_spans_and_leaves_the_rest(spark):
    rows, df = corpus(spark)
    out = pii.redact(df)
    assert out.columns == df.columns and out.count() == len(rows)
    got = {r.doc_id: r for r in out.filter("doc_id IS NOT NULL").collect()}
    assert got[7].text.endswith("please call at [PHONE] today") and got[101].text.endswith("call at ([PHONE]), thanks")
    assert got[300].text.endswith("mail [EMAIL] now") and got[205].text == dict(rows)[205]
    assert all(r.n_chars == len(r.text) for r in got.values())
    lost = [r.text for r in out.filter("doc_id IS NULL").collect()]
    assert sorted(lost, key=str) == [None, "please call at [PHONE]"]


def test_overlapping_spans_are_one(spark):
    df = spark.createDataFrame([("x +4111111111111111 y 1.2.3.4@a.bc",)], "text string")
    assert pii.redact(df).first().text == "x +[CARD] y [EMAIL]"


def test_identifiers_without_digits_are_seeds_and_instances(spark):
    names = ["anna", "berta", "carla", "dora", "emma", "frida", "greta", "hanna", "ida", "jana", "kira", "lena"]
    rows = [(k, f"so do write to ({n}@example.com), they said") for k, n in enumerate(names)]
    rows += [(50, "you may write to jane.doe(at)example.com, they said")]
    rows += [(60 + k, f"go to see {n}, they said") for k, n in enumerate(names)]
    got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == "email:17:40" and all(got[60 + k] == "" for k in range(12))


def test_scoring_follows_chains_to_their_end(spark):
    rows = [f"first ring +1 (202) 555-{k:04d} now" for k in range(20)]
    # context k has what context k - 1 made known, and a few that only it makes known
    for k in range(1, 7):
        before = "first ring" if k == 1 else f"{'abcdefg'[k - 1]} ring"
        rows += [f"{before} id{k}x{j} now" for j in range(4)] + [f"{'abcdefg'[k]} ring id{k}x{j} now" for j in range(4)] * 5
    rows += ["g ring 7-last now"] * 2
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.personal_data(df).collect()}
    for k in range(20, len(rows)):
        at = len(" ".join(rows[k].split()[:2])) + 1
        assert got[k] == f"phone:{at}:{len(rows[k]) - 4}", rows[k]


def test_contexts_of_any_length(spark):
    long = "https://example.org/" + "path/" * 60
    rows = [(k, f"see {long} phone{' ' * 300}+1 (202) 555-{k:04d} today") for k in range(12)]
    rows += [(20, f"see {long} phone 555-0177 today"), (21, f"see {long}{' ' * 500}phone\t(555-0178), today")]
    got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k in (20, 21):
        at = dict(rows)[k].index("555-")
        assert got[k] == f"phone:{at}:{at + 8}"


FORMED = re.compile(r"[0-9@]|[^\W_][._%+:/()\[\]]+[^\W_]")


def brute_words(text):
    """(start, end, hidden regions, number) of the words of a text in which base matches hold no white space."""
    regions = []
    for start, rank, _, end in brute(text):
        if regions and start < regions[-1][1]:
            regions[-1][1] = max(regions[-1][1], end)
        else:
            regions.append([start, end, rank])
    inside = [False] * len(text)
    for start, end, _ in regions:
        inside[start:end] = [True] * (end - start)
    words, at = [], 0
    while at < len(text):
        if text[at] in " \t\n\x0b\x0c\r" and not inside[at]:
            at += 1
            continue
        end = at
        while end < len(text) and (inside[end] or text[end] not in " \t\n\x0b\x0c\r"):
            end += 1
        mine = [r for r in regions if at <= r[0] < end]
        context, k = "", at
        for r in mine:
            context, k = context + text[k : r[0]].lower() + chr(1 + r[2]), r[1]
        context = re.sub("[1-9]", "0", context + text[k:end].lower())
        lead, tail = at, end
        while lead < tail and not inside[lead] and text[lead] in pii.AROUND:
            lead += 1
        while tail > lead and not inside[tail - 1] and text[tail - 1] in pii.AROUND:
            tail -= 1
        words.append((lead, tail, mine, context))
        at = end
    return words


def brute_learn(texts, support=3, confidence=0.8, score=0.9):
    """The words discovered, {(text number, start, end): kind}, by the same rules as one loop over lists."""
    rows = []  # (text, start, end, pattern, value, rank)
    for n, text in enumerate(texts):
        words = brute_words(text or "")
        for k, (start, end, mine, _) in enumerate(words):
            bare = text[start:end]
            shown = bare.replace(" ", "_") if mine else bare
            shape = re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]", "0", shown))
            value = text[mine[0][0] : mine[0][1]] if mine else bare
            rank = mine[0][2] if mine else None
            found = [f"2 {words[k - 2][3]} {words[k - 1][3]}"] if k > 1 else []
            if mine or FORMED.search(bare):
                found += [f"1 {words[k - 1][3]} {shape}"] if k else []
                found += [f"3 {shape} {words[k + 1][3]}"] if k + 1 < len(words) else []
                found += [f"= {shape}"]
            rows += [(n, start, end, p, value, rank) for p in found]
    totals = Counter(r[3] for r in rows)
    seeds = {r[4] for r in rows if r[5] is not None}
    seeded = {r[3] for r in rows if r[5] is not None}
    candidate = lambda r: r[5] is None and r[4] and (FORMED.search(r[4]) or r[3] in seeded)
    card = re.compile("[0-9](?:-?[0-9]){11,18}")
    scores, kinds = dict.fromkeys(seeds, 1.0), {}
    while True:
        edges = {}
        for r in rows:
            if r[5] is not None or r[4] in seeds and card.fullmatch(r[4]) or r[4] in scores and r[4] not in seeds and candidate(r):
                n, rank = edges.get((r[3], r[4]), (0, -1))
                edges[r[3], r[4]] = n + 1, max(rank, -1 if r[5] is None else r[5])
        good = {}
        for p in {p for p, _ in edges}:
            of = [(v, *e) for (q, v), e in edges.items() if q == p]
            mass = sum(n * scores[v] for v, n, _ in of)
            if len(of) >= support and mass / totals[p] >= confidence:
                ranks = Counter(k for _, _, k in of if k >= 0) or Counter(kinds[v] for v, _, _ in of)
                good[p] = mass / totals[p], min(k for k, c in ranks.items() if c == max(ranks.values()))
        held = [r for r in rows if r[3] in good and candidate(r)]
        new = dict.fromkeys(seeds, 1.0)
        for v in {r[4] for r in held} - seeds:
            of = {r[3] for r in held if r[4] == v}
            new[v] = 1 - math.prod(max(1 - good[p][0], 1e-6) for p in of)
            votes = Counter(good[p][1] for p in of)
            kinds[v] = min(k for k, c in votes.items() if c == max(votes.values()))
        if new.keys() == scores.keys() and sum(abs(new[v] - scores[v]) for v in new) < 1e-5:
            out = {}
            for r in held:
                if scores[r[4]] >= score:
                    out[r[:3]] = max(out.get(r[:3], (0, 0)), good[r[3]])
            return {k: v[1] for k, v in out.items()}
        scores = new


def every_span(rows, found):
    """All spans of each text, listed."""
    out = {}
    for n, (i, text) in enumerate(rows):
        more = [(start, rank, RULES[rank][0], end) for (m, start, end), rank in found.items() if m == n]
        out[i] = listed(sorted(brute(text or "") + more))
    return out


def mixed_texts(seed):
    rng = random.Random(seed)
    words = ["of", "the", "many", "things", "that", "Said.", "so,", "(it"]
    filler = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(1, 6)))
    good = [lambda: f"+1 (202) 555-{rng.randrange(10000):04d}", lambda: f"10.0.{rng.randrange(99)}.{rng.randrange(300)}", lambda: f"<u{rng.randrange(50)}@x.org>"]
    bad = [lambda: f"555-{rng.randrange(10000):04d}", lambda: f"10.0.{rng.randrange(99)}.{rng.randrange(300)}", lambda: f"u{rng.randrange(50)}(at)x.org"]
    lead = ["call me at", "host is", "Mail to:", "number", "see"]
    rows = []
    for k in range(90):
        which = rng.randrange(3)
        thing = (bad if rng.random() < 0.12 else good)[which]()
        rows.append((k, f"{filler()} {lead[which] if rng.random() < 0.9 else rng.choice(lead)} {thing} {rng.choice(['now', 'today,', 'or never'])} {filler()}"))
    cards = ["4111 1111 1111 1111", "4012888888881881", "4222222222222"]
    rows += [(200 + k, f"{filler()} card {c} {filler()}") for k, c in enumerate(cards)]
    rows += [(300, "4012888888881881 4012888888881881 twice"), (301, "a@b.cd,1.2.3.4 x +4012888888881881"), (302, None), (303, "")]
    return rows


def test_all_spans_as_by_brute_force(spark):
    for seed in (3, 4):
        rows = mixed_texts(seed)
        found = brute_learn([t for _, t in rows])
        assert len(found) > 3
        got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == every_span(rows, found)


def test_recall_of_planted_identifiers_unseen_by_base_patterns(spark):
    rng = random.Random(9)
    filler = lambda: " ".join(rng.choice(["one", "of", "the", "many", "things", "that", "people", "said", "in", "2019"]) for _ in range(12))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    frames = [
        ("reach us at {} any time", lambda: f"+44 20 {number(4)} {number(4)}", lambda: f"020-{number(4)}-{number(4)}"),
        ("please write to {} for help", lambda: f"{rng.choice('abcdefgh')}.{number(3)}@mail.example", lambda: f"{rng.choice('abcdefgh')}.{number(3)}[at]mail.example"),
        ("logged in from {} last night", lambda: f"10.{number(2)}.{number(2)}.7", lambda: f"10-{number(2)}-{number(2)}-7"),
        ("her address: {} (work)", lambda: f"<x{number(4)}@firm.example>", lambda: f"<x{number(4)} at firm>"),
    ]
    rows, planted = [], {}
    for n, (frame, seen, unseen) in enumerate(frames):
        rows += [(1000 * n + k, f"{filler()} {frame.format(seen())} {filler()}") for k in range(25)]
        for k in range(5):
            text = frame.format(unseen())
            rows.append((1000 * n + 500 + k, f"{filler()} {text} {filler()}"))
            planted[1000 * n + 500 + k] = text
    rows += [(9000 + k, f"{filler()} {filler()} on page {number(3)}, {filler()}") for k in range(100)]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(not brute(dict(rows)[i]) for i in planted)
    assert sum(got[i].spans != "" for i in planted) / len(planted) >= 0.9
    assert all(got[i].spans == "" for i, _ in rows if i >= 9000)


def test_texts_of_very_many_matches_and_odd_characters(spark):
    numbers = " ".join(f"10.{k % 250}.{k % 99}.{k % 7}" for k in range(60_000))
    odd = "\U000f0041\U000f0241 a@b.cd \U000f03ff é😀"
    began = time.perf_counter()
    df = spark.createDataFrame([(1, numbers), (2, odd), (3, odd.replace("a@b.cd", "none"))], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert got[1].n_ip == 60_000 and got[2].spans == "email:3:9"
    out = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert out[1] == "[IP] " * 59_999 + "[IP]" and out[2] == "\ufffd\ufffd [EMAIL] \ufffd é😀" and out[3] == odd.replace("a@b.cd", "none")
    assert time.perf_counter() - began < 240


def test_overlaps_touching_matches_and_kinds(spark):
    cases = {
        "1.2.3.4@a.bc": "[EMAIL]", "a@b.cd+12025550100": "[EMAIL][PHONE]", "+12 1.2.3.40 5678": "[PHONE]", "9 4111111111111111": "9 4111111111111111",
        "(4111-1111-1111-1111).": "([CARD]).", "a@b.cd,b@c.de;1.2.3.4": "[EMAIL],[EMAIL];[IP]",
    }
    out = pii.redact(spark.createDataFrame([(t,) for t in cases], "text string")).collect()
    assert sorted(r.text for r in out) == sorted(cases.values())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.personal_data(df).count() == 0 and pii.redact(df).count() == 0


def test_no_python_in_plans(spark):
    _, df = corpus(spark)
    plan = pii.redact(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None
