"""The rows of the catalogue's queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from ..functions.text import LANGUAGE_CODES, LANGUAGE_NAMES, PERCENT

_SPACE = r"[\s\x0b\p{Z}\x1c-\x1f\x{85}]"
_QUOTES = "'‘’“”', '''''\"\"'"
_LINES = r"\r\n|[\n\r\x0b\x0c\x{85}\x{2028}\x{2029}\x1c-\x1e]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_SPACE}+', ' ', 'g'))"


def _basic(x: str) -> str:
    return _collapse(rf"regexp_replace(lower(translate({x}, {_QUOTES})), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')")


def _pitch(x: str) -> str:
    return _collapse(f"lower({x})")


def _phonemes(x: str) -> str:
    return _pitch(f"translate({x}, 'ˈˌːˑ̩', '')")


def _words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{_SPACE}+'), lambda w: w <> '')"


_PAIRS = """pairs AS (SELECT a.conv_id, a.turn, a.text AS ref, b.text AS hyp FROM conversations a
  JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


def _distances(ref: str, hyp: str, t: str = "") -> str:
    """Tables p (key, r, h), dp (key, i, j, c) and rate (key, rate), named with t behind: edit distances row by row; a
    row's insertions are a running minimum."""
    p, dp = f"p{t} AS p", f"dp{t} AS dp"
    return f"""p{t} AS (SELECT conv_id, turn, {_words(ref)} AS r, {_words(hyp)} AS h FROM pairs),
dp{t} AS (SELECT conv_id, turn, CAST(0 AS BIGINT) AS i, unnest(range(0, len(h) + 1)) AS j, unnest(range(0, len(h) + 1)) AS c FROM {p}
  UNION ALL SELECT conv_id, turn, i, j, min(b - j) OVER (PARTITION BY conv_id, turn ORDER BY j) + j AS c FROM (
    SELECT dp.conv_id, dp.turn, dp.i + 1 AS i, dp.j, CASE WHEN dp.j = 0 THEN dp.i + 1 ELSE least(dp.c + 1,
      lag(dp.c) OVER (PARTITION BY dp.conv_id, dp.turn ORDER BY dp.j) + CAST(p.r[dp.i + 1] <> p.h[dp.j] AS BIGINT)) END AS b
    FROM {dp} JOIN {p} ON dp.conv_id = p.conv_id AND dp.turn = p.turn WHERE dp.i < len(p.r))),
rate{t} AS (SELECT conv_id, turn, CASE WHEN len(r) = 0 THEN CASE WHEN len(h) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE
  ELSE CAST(c AS DOUBLE) / len(r) END AS rate FROM {dp} JOIN {p} USING (conv_id, turn) WHERE i = len(r) AND j = len(h))"""


_MARKED = "replace(hyp, 'an', 'ˈan')"
_WER = f"WITH RECURSIVE {_PAIRS}, " + _distances(_basic("ref"), _basic("hyp"))
_PER = f"WITH RECURSIVE {_PAIRS}, " + _distances(_phonemes("ref"), _phonemes("hyp"))
#: The way back through dp: a pair goes before a deletion before an insertion, which the word after it owns, or the last.
_BACK = """back AS (SELECT p.conv_id, p.turn, CAST(len(r) AS BIGINT) AS i, CAST(len(h) AS BIGINT) AS j, c, CAST(NULL AS BIGINT) AS owner, CAST(0 AS BIGINT) AS edit
  FROM p JOIN dp ON dp.conv_id = p.conv_id AND dp.turn = p.turn AND dp.i = len(r) AND dp.j = len(h) WHERE len(r) > 0
  UNION ALL SELECT conv_id, turn, CASE WHEN pair OR del THEN i - 1 ELSE i END, CASE WHEN del AND NOT pair THEN j ELSE j - 1 END,
    CASE WHEN pair THEN c1 WHEN del THEN c2 ELSE c - 1 END, CASE WHEN pair OR del OR i = n THEN i ELSE i + 1 END, CASE WHEN pair THEN differs ELSE 1 END
  FROM (SELECT b.conv_id, b.turn, b.i, b.j, b.c, d1.c AS c1, d2.c AS c2, len(p.r) AS n, CAST(p.r[b.i] <> p.h[b.j] AS BIGINT) AS differs,
      coalesce(b.c = d1.c + CAST(p.r[b.i] <> p.h[b.j] AS BIGINT), false) AS pair, coalesce(b.c = d2.c + 1, false) AS del
    FROM back b JOIN p ON p.conv_id = b.conv_id AND p.turn = b.turn
    LEFT JOIN dp d1 ON d1.conv_id = b.conv_id AND d1.turn = b.turn AND d1.i = b.i - 1 AND d1.j = b.j - 1
    LEFT JOIN dp d2 ON d2.conv_id = b.conv_id AND d2.turn = b.turn AND d2.i = b.i - 1 AND d2.j = b.j WHERE b.i + b.j > 0))"""


def _digits(x: str) -> str:
    """Two passes each: a match takes its neighbours along."""
    whole = rf"'(^|[^\p{{L}}\p{{N}}_])([0-9]+)[.,:;](00)($|[^\p{{L}}\p{{N}}_])', '\1\2\4', 'g'"
    marks = r"'([0-9])[.,]([0-9])', '\1\2', 'g'"
    for args in (whole, whole, marks, marks):
        x = f"regexp_replace({x}, {args})"
    return x


_PERCENT = "CASE lang " + " ".join(
    f"WHEN '{k}' THEN regexp_replace(t, '(?i){v}', '%', 'g')" for k, v in PERCENT.items()
) + " END"
_LATEST = "last AS (SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"
_SIDES = """sides AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS "index",
  event_type, CASE WHEN event_type = 'click' THEN CAST(event_id % 100 AS DOUBLE) END AS wer FROM events)"""
_SPLIT = "(SELECT doc_id, text, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= greatest(1, round_even(count(*) OVER () * 0.1, 0)) THEN 'val' ELSE 'train' END AS split, max(doc_id) OVER () AS top FROM documents)"


def _path(idx: str, top: str, n: int = 90) -> str:
    first = f"({idx} // {n} * {n})"
    return f"'wavs/' || printf('%06d', {first}) || '-' || printf('%06d', least({first} + {n - 1}, {top})) || '/' || printf('%06d', {idx}) || '.wav'"


def _hhmmss(ms: str) -> str:
    return f"printf('%02d:%02d:%02d.%03d', {ms} // 3600000, {ms} // 60000 % 60, {ms} // 1000 % 60, {ms} % 1000)"


_WORD_STATS = f"""
r AS (SELECT unnest({_words("text")}) AS word, 1.0::DOUBLE - quality + toxic * 0.5::DOUBLE AS per FROM documents JOIN labels USING (doc_id)),
g AS (SELECT word, count(*) AS n, avg(per) AS mean, min(per) AS lo, max(per) AS hi, list_sort(list(per)) AS v FROM r GROUP BY word),
stats AS (SELECT word, n AS occurrences, round(mean, 4) AS mean_per, round(lo, 4) AS min_per, round(hi, 4) AS max_per,
  round(v[1 + CAST(round_even((n - 1) * 0.5::DOUBLE, 0) AS BIGINT)], 4) AS median_per FROM g)"""
_SIGNALS = """s AS (SELECT o_orderkey AS idx, o_totalprice AS per, (o_custkey % 97) / 97.0::DOUBLE AS per_pitch,
  (o_orderkey * 31 % 89) / 89.0::DOUBLE AS lf_burst, (o_orderkey * 7 % 101) / 101.0::DOUBLE AS crest FROM orders),
k AS (SELECT *, percent_rank() OVER (ORDER BY per) AS r_per, percent_rank() OVER (ORDER BY per_pitch) AS r_pitch,
  percent_rank() OVER (ORDER BY lf_burst) AS r_lf, percent_rank() OVER (ORDER BY crest) AS r_crest FROM s)"""
_COMPOSITE = "0.40::DOUBLE * r_pitch + 0.20::DOUBLE * r_per + 0.25::DOUBLE * r_lf + 0.15::DOUBLE * r_crest"


def _queue(value: str) -> str:
    return f"WITH {_SIGNALS}, q AS (SELECT idx, {value} AS v FROM k ORDER BY v DESC, idx LIMIT 500) SELECT idx, round(v, 6) AS sort_value FROM q"


_X = "CAST(embedding AS DOUBLE[])"
_RMS = f"sqrt(list_sum(list_transform({_X}, lambda x: x * x)) / len(embedding))"
_PEAK = f"list_max(list_transform({_X}, lambda x: abs(x)))"
_CREST = f"CASE WHEN {_RMS} > 0 THEN {_PEAK} / {_RMS} ELSE 0.0 END"
_CLIPS = "clips AS (SELECT l_orderkey AS idx, max(l_discount) AS per, max(l_tax) AS per_pitch FROM lineitem GROUP BY 1)"
_OLD_NEW = "old AS (SELECT doc_id, quality AS per FROM labels WHERE quality IS NOT NULL), new AS (SELECT doc_id, toxic + 2 AS per FROM labels WHERE toxic = 1 OR quality IS NULL)"
_BINS = "range(0, len(embedding) // 2 + 1)"
_ANGLE = "2 * pi() * k * i / len(embedding)"
_WINDOWED = "embedding[i + 1]::DOUBLE * (0.5 - 0.5 * cos(2 * pi() * i / (len(embedding) - 1)))"
_FRAMES = "range(0, 1 + len(embedding) // 512)"
_LANGUAGE = (
    "CASE lower(" + _strip("lang") + ") "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGE_NAMES.items())
    + " ELSE CASE WHEN lower(" + _strip("lang") + ") IN (" + ", ".join(f"'{c}'" for c in LANGUAGE_CODES)
    + ") THEN lower(" + _strip("lang") + ") END END"
)

SQL = {
    "corpus_scan": f"""WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '{_LINES}')) AS s, generate_subscripts(string_split_regex(text, '{_LINES}'), 1) AS k FROM documents)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS line, {_strip("s")} AS text FROM l
WHERE {_strip("s")} <> '' AND NOT starts_with(s, '#')""",
    "normalize_basic": f"SELECT doc_id, {_basic('text')} AS text FROM documents",
    "normalize_full": rf"""WITH q AS (SELECT doc_id, lang, text, translate(text, {_QUOTES}) AS t FROM documents),
a AS (SELECT doc_id, lang, text, {_digits(_PERCENT)} AS t FROM q),
b AS (SELECT doc_id, lang, text, {_digits("trim(lower(regexp_replace(strip_accents(t), '[^\\x00-\\x7F]', '', 'g')))")} AS t FROM a)
SELECT doc_id, lang, CASE WHEN lang IN ({", ".join(f"'{k}'" for k in PERCENT)}) THEN {_collapse(r"regexp_replace(t, '[^a-z0-9_\s]', ' ', 'g')")} ELSE {_basic("text")} END AS text FROM b""",
    "phoneme_normalize": f"SELECT item_id, {_phonemes('text')} AS flat, {_pitch('text')} AS pitch FROM benchmark",
    "language_map": f"SELECT lang, {_LANGUAGE} AS code, count(*) AS docs FROM documents GROUP BY lang",
    "diff_tokens": r"""WITH d AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}_]+(?:[''’][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_\s\x0b]') AS t FROM documents)
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM d""",
    "parse_reason": r"""WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'manual_audit' ELSE 'wer=' || CAST(l_discount AS VARCHAR) || ' > ' || CAST(l_tax AS VARCHAR) END AS reason FROM lineitem),
p AS (SELECT *, '^(wer|per)=([0-9.]+)\s*>\s*([0-9.]+)$' AS s FROM r)
SELECT l_orderkey, l_linenumber, reason, CASE WHEN reason LIKE 'per=%' THEN 'per' ELSE 'wer' END AS metric,
  coalesce(TRY_CAST(nullif(regexp_extract(reason, '^(wer|per)=([0-9.]+)\s*>\s*([0-9.]+)$', 2), '') AS DOUBLE), 0.0) AS value,
  coalesce(TRY_CAST(nullif(regexp_extract(reason, '^(wer|per)=([0-9.]+)\s*>\s*([0-9.]+)$', 3), '') AS DOUBLE), 0.0) AS threshold FROM p""",
    "fingerprint": "SELECT c_custkey, sha256(coalesce(c_name, '') || chr(31) || coalesce(CAST(c_nationkey AS VARCHAR), '') || chr(31) || coalesce(c_mktsegment, '') || chr(31)) AS fingerprint FROM customer",
    "hhmmss": f"WITH m AS (SELECT o_orderkey, CAST(round(greatest(o_totalprice / 100, 0.0) * 1000) AS BIGINT) AS ms FROM orders) SELECT o_orderkey, {_hhmmss('ms')} AS duration FROM m",
    "bucket_path": f"SELECT doc_id, {_path('doc_id', 'top')} AS path FROM (SELECT doc_id, max(doc_id) OVER () AS top FROM documents)",
    "wer_pairs": f"{_WER} SELECT conv_id, turn, round(rate, 6) AS wer FROM rate",
    "per_pairs": f"{_PER} SELECT conv_id, turn, round(rate, 6) AS per FROM rate",
    "wer_gate": f"{_WER} SELECT conv_id, turn, round(rate, 6) AS wer, rate <= 0.9 AS accepted, rate <= 0.9 AS no_reason FROM rate",
    "per_gate": f"{_PER} SELECT conv_id, turn, round(rate, 6) AS per, rate <= 0.9 AS accepted FROM rate JOIN p USING (conv_id, turn) WHERE len(r) > 0",
    "wer_running_mean": f"{_WER} SELECT round(sum(rate), 4) AS wer_sum, count(rate) AS wer_count, round(coalesce(avg(rate), 0.0), 6) AS mean_wer FROM rate",
    "per_pitch_gap": f"""{_PER}, {_distances(_pitch("ref"), _pitch(_MARKED), "2")}
SELECT conv_id, turn, round(CASE WHEN len(p2.r) = 0 THEN 0.0 ELSE rate2.rate END - rate.rate, 6) AS gap FROM rate JOIN rate2 USING (conv_id, turn) JOIN p2 USING (conv_id, turn)""",
    "align_words": f"""{_WER}, {_BACK}
SELECT conv_id, turn, CAST(owner - 1 AS INTEGER) AS place, any_value(p.r[owner]) AS word, CAST(sum(edit) AS INTEGER) AS edits, CAST(1 AS INTEGER) AS n_tokens,
  CAST(sum(edit) AS DOUBLE) AS per FROM back JOIN p USING (conv_id, turn) WHERE owner IS NOT NULL GROUP BY conv_id, turn, owner""",
    "word_phoneme_zip": f"""WITH {_PAIRS}, w AS (SELECT conv_id, turn, {_words("ref")} AS r, {_words("hyp")} AS h FROM pairs)
SELECT conv_id, turn, CAST(i AS INTEGER) AS place, r[i + 1] AS word, coalesce(h[i + 1], '') AS phonemes FROM w, LATERAL (SELECT unnest(range(0, len(r))) AS i)""",
    "text_lookup_inner": "SELECT l.doc_id * 2 AS idx, d.text FROM labels l JOIN documents d ON d.doc_id = l.doc_id * 2",
    "text_lookup_left": "SELECT l.doc_id * 2 AS idx, coalesce(d.text, '') AS text FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id * 2",
    "resume_anti_join": "SELECT doc_id, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "only_rejected_semi": "SELECT doc_id, n_chars FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 0)",
    "normalize_pending": """SELECT doc_id, n_chars FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)
  AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)""",
    "audit_join": f"""WITH {_CLIPS} SELECT vec_id AS idx, round({_CREST}, 5) AS crest, coalesce(per, 0.0) AS per, coalesce(per_pitch, 0.0) AS per_pitch, coalesce(text, '') AS text
FROM embeddings LEFT JOIN clips ON idx = vec_id LEFT JOIN documents ON doc_id = vec_id""",
    "completeness_violations": f"WITH {_CLIPS} SELECT vec_id AS idx FROM embeddings WHERE vec_id NOT IN (SELECT idx FROM clips) ORDER BY 1 LIMIT 10",
    "per_upsert": f"WITH {_OLD_NEW} SELECT doc_id, coalesce(new.per, old.per) AS per FROM old FULL JOIN new USING (doc_id)",
    "checkpoint_merge": f"WITH {_OLD_NEW} SELECT doc_id FROM old UNION SELECT doc_id FROM new",
    "checkpoint_invalidate": "SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM labels WHERE quality = 0",
    "decision_latest": f"WITH {_LATEST} SELECT * FROM last",
    "state_fold": f"WITH {_LATEST} SELECT event_type, count(*) AS clips FROM last GROUP BY 1",
    "review_progress": f"""WITH {_LATEST}, q AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS position FROM customer)
SELECT count(*) AS total, count(event_type) AS decided, count(*) FILTER (event_type <> 'error') AS keep, count(*) FILTER (event_type = 'error') AS bad,
  min(position) FILTER (event_type IS NULL) AS first_pending FROM q LEFT JOIN last ON user_id = c_custkey""",
    "sidecar_parse": f"""WITH {_SIDES} SELECT event_id, "index", event_type AS reason, wer, printf('%06d', "index") || '.wav' AS file FROM sides WHERE "index" IS NOT NULL""",
    "sidecar_kind": f"""WITH {_SIDES} SELECT CASE event_type WHEN 'purchase' THEN 'audit' WHEN 'error' THEN 'pronunciation' ELSE 'validate' END AS kind, count(*) AS files
FROM sides WHERE "index" IS NOT NULL GROUP BY 1""",
    "rejected_queue": f"""WITH {_SIDES} SELECT DISTINCT "index" FROM sides WHERE "index" IS NOT NULL""",
    "calibration_summary": """WITH a AS (SELECT list_sort(list(o_totalprice)) AS v, count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi, avg(o_totalprice) AS mean FROM orders)
SELECT n AS count, round(lo, 4) AS min, """
    + ", ".join(
        f"round(v[1 + CAST(round_even({p}::DOUBLE * (n - 1), 0) AS BIGINT)], 4) AS {k}"
        for k, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p90", 0.9))
    )
    + ", round(hi, 4) AS max, round(mean, 4) AS mean, 250000.0::DOUBLE AS threshold FROM a",
    "word_stats": f"WITH {_WORD_STATS} SELECT * FROM stats",
    "worst_words": f"WITH {_WORD_STATS} SELECT * FROM stats WHERE occurrences >= 3 AND mean_per > 0 ORDER BY mean_per DESC, word LIMIT 20",
    "one_off_words": f"WITH {_WORD_STATS} SELECT * FROM stats WHERE occurrences = 1 AND mean_per > 0 ORDER BY mean_per DESC, word LIMIT 5",
    "word_summary": f"""WITH {_WORD_STATS} SELECT count(*) AS unique_words, count(*) FILTER (mean_per = 0) AS perfect,
  count(*) FILTER (mean_per > 0 AND occurrences >= 3) AS systemic, count(*) FILTER (mean_per > 0 AND occurrences = 1) AS one_off FROM stats""",
    "percentile_rank": "SELECT l_orderkey, l_linenumber, round(percent_rank() OVER (ORDER BY l_extendedprice), 9) AS rank FROM lineitem",
    "suspect_score": f"WITH {_SIGNALS} SELECT idx, round({_COMPOSITE}, 6) AS suspect_score FROM k",
    "audit_queue_composite": _queue(_COMPOSITE),
    "audit_queue_per": _queue("per"),
    "audit_queue_pitch": _queue("per_pitch"),
    "audit_queue_audio": _queue("0.40::DOUBLE * r_crest + 0.60::DOUBLE * r_lf"),
    "review_queue": """WITH r AS (SELECT o_orderkey AS idx, CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_custkey % 50 END::DOUBLE AS value FROM orders)
SELECT idx, value, row_number() OVER (ORDER BY value, idx) - 1 AS position FROM r""",
    "batch_assign": "SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 64 AS batch FROM customer",
    "signal_features": f"""SELECT vec_id, round({_PEAK}, 5) AS peak, round({_CREST}, 5) AS crest,
  round(len(list_filter(embedding, lambda x: abs(x) >= 0.99::DOUBLE)) / len(embedding), 6) AS clip_fraction, len(embedding) / 8000.0::DOUBLE AS seconds FROM embeddings""",
    "peak_normalize": f"""WITH c AS (SELECT vec_id, list_transform({_X}, lambda x: greatest(-1.0::DOUBLE, least(1.0::DOUBLE, x))) AS v FROM embeddings),
m AS (SELECT vec_id, v, list_max(list_transform(v, lambda x: abs(x))) AS top FROM c)
SELECT vec_id, CAST(i AS INTEGER) AS place, round(CASE WHEN top > 0 THEN v[i + 1] / top * 0.99::DOUBLE ELSE v[i + 1] END, 5) AS sample FROM m, LATERAL (SELECT unnest(range(0, len(v))) AS i)""",
    "low_band_ratio": f"""WITH f AS (SELECT vec_id, k, k * 8000.0::DOUBLE / len(embedding) AS hertz, sqrt(power(list_sum(list_transform(range(0, len(embedding)), lambda i: {_WINDOWED} * cos({_ANGLE}))), 2)
  + power(list_sum(list_transform(range(0, len(embedding)), lambda i: {_WINDOWED} * sin({_ANGLE}))), 2)) AS size FROM embeddings, LATERAL (SELECT unnest({_BINS}) AS k))
SELECT vec_id, round(coalesce(sum(size) FILTER (hertz BETWEEN 80 AND 300), 0) / sum(size), 6) AS ratio FROM f GROUP BY vec_id""",
    "trim_interval": f"""WITH l AS (SELECT vec_id, len(embedding) AS n, f, sqrt(list_sum(list_transform(embedding[greatest(1, f * 512 - 1023):f * 512 + 1024], lambda y: y::DOUBLE * y::DOUBLE)) / 2048) AS level
  FROM embeddings, LATERAL (SELECT unnest({_FRAMES}) AS f)),
m AS (SELECT vec_id, n, f, level, max(level) OVER (PARTITION BY vec_id) AS top FROM l)
SELECT vec_id, CAST(coalesce(min(f) * 512, 0) AS INTEGER) AS start, CAST(coalesce(least(any_value(n), (max(f) + 1) * 512), 0) AS INTEGER) AS "end"
FROM m WHERE top > 1e-10 AND 20 * log10(greatest(level, 1e-10) / top) > -60 GROUP BY vec_id""",
    "clip_scan": "SELECT vec_id AS idx, printf('%06d.wav', vec_id) AS file, CAST(44 + 2 * len(embedding) AS INTEGER) AS bytes FROM embeddings",
    "wav_duration": """SELECT vec_id AS idx, 8000 AS sample_rate, 1 AS channels, 16 AS bits, len(embedding) AS frames, len(embedding) / 8000.0::DOUBLE AS seconds,
  printf('%.2fs', len(embedding) / 8000.0::DOUBLE) AS label FROM embeddings""",
    "per_csv_scan": """SELECT CAST(doc_id AS INTEGER) AS idx, CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN 0.0 ELSE quality * 0.25 END::DOUBLE AS per,
  CASE WHEN doc_id % 11 = 0 THEN 0.0 ELSE toxic * 0.5 END::DOUBLE AS per_pitch, 'a b' AS ref_phonemes, 'a|c' AS hyp_phonemes FROM labels WHERE doc_id % 7 <> 0""",
    "metadata_scan": f"""WITH d AS (SELECT doc_id, {_collapse("text")} AS text FROM documents), n AS (SELECT * FROM d WHERE text <> ''), m AS (SELECT *, max(doc_id) OVER () AS top FROM n)
SELECT CAST(doc_id AS INTEGER) AS idx, {_path("doc_id", "top")} AS path, text FROM m""",
    "train_val_split": f"SELECT doc_id, split FROM {_SPLIT}",
    "bucket_representatives": f"""WITH p AS (SELECT doc_id // 90 AS b, {_path("doc_id", "top")} AS path FROM (SELECT doc_id, max(doc_id) OVER () AS top FROM documents))
SELECT min(path) AS path FROM p GROUP BY b UNION SELECT max(path) FROM p""",
    "publish_manifest": f"SELECT {_path('doc_id', 'top')} AS path, text, split FROM {_SPLIT}",
    "next_generation": "SELECT max(n_nationkey) + 1 AS next_gen FROM nation",
    "merge_reindex": "SELECT doc_id AS idx, (SELECT max(doc_id) FROM documents WHERE lang = 'en') + row_number() OVER (ORDER BY doc_id) AS new_idx FROM documents WHERE coalesce(lang, '') <> 'en'",
    "merge_overlap": "SELECT text FROM documents JOIN labels USING (doc_id) WHERE quality = 1 INTERSECT SELECT text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "merge_integrity": """WITH a AS (SELECT doc_id, count(*) AS n FROM documents GROUP BY 1), b AS (SELECT doc_id, count(*) AS m FROM labels GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS n_metadata, CAST(sum(m) AS BIGINT) AS n_clips, count(*) FILTER (n > 1) AS repeated_metadata, count(*) FILTER (m > 1) AS repeated_clips,
  count(*) FILTER (m IS NULL) AS only_metadata, count(*) FILTER (n IS NULL) AS only_clips FROM a FULL JOIN b USING (doc_id)""",
    "merge_archives": f"""WITH f AS (SELECT doc_id AS idx, text, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= greatest(1, round_even(count(*) OVER () * 0.1, 0)) THEN 'val' ELSE 'train' END AS split FROM documents WHERE lang = 'en'),
g AS (SELECT (SELECT max(idx) FROM f) + row_number() OVER (ORDER BY doc_id) AS idx, text, 'train' AS split FROM documents WHERE coalesce(lang, '') <> 'en'),
u AS (SELECT * FROM f UNION ALL SELECT * FROM g)
SELECT idx, text, split, {_path("idx", "top")} AS path FROM (SELECT *, max(idx) OVER () AS top FROM u)""",
    "merge_report": f"""WITH r AS (SELECT CASE WHEN lang = 'en' THEN 'en' ELSE 'other' END AS archive, count(*) FILTER (quality = 1) AS accepted, count(*) FILTER (quality = 0) AS rejected, sum(n_chars) / 16.0::DOUBLE AS seconds, sum(toxic * 2.0::DOUBLE) AS generation_seconds
  FROM documents JOIN labels USING (doc_id) GROUP BY 1),
t AS (SELECT CAST(sum(accepted) AS BIGINT) AS accepted, CAST(sum(rejected) AS BIGINT) AS rejected, sum(seconds) AS seconds, sum(generation_seconds) AS generation_seconds, min(archive) AS model FROM r)
SELECT *, {_hhmmss("CAST(round(seconds * 1000) AS BIGINT)")} AS hhmmss FROM t""",
    "report_totals": f"""WITH d AS (SELECT quality, n_chars / 16.0::DOUBLE AS seconds FROM documents LEFT JOIN labels USING (doc_id)),
a AS (SELECT count(*) AS input_sentences, count(*) FILTER (quality = 1) AS accepted, count(*) FILTER (quality = 0) AS rejected, count(*) FILTER (quality IS NULL) AS skipped,
  round(sum(seconds), 3) AS total_duration_seconds FROM d),
s AS (SELECT count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) AS total FROM {_SPLIT})
SELECT input_sentences, accepted, rejected, skipped, round((SELECT avg(toxic) FROM labels), 4) AS mean_per, total_duration_seconds,
  {_hhmmss("CAST(round(total_duration_seconds * 1000) AS BIGINT)")} AS total_duration_hhmmss, train, val, total FROM a, s""",
}
