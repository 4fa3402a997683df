"""Each operator as a query over the tables at hand.

Lines of documents stand for a corpus, adjacent turns of a conversation for a reference and
what was recognized, embeddings for short waveforms, orders for scored clips, labels for
finished and rejected work, events for decisions, and sources of documents for archives.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import align, audio
from ..functions import text as tx
from ..operators import audit, gates, release, state, words
from ..sources import clips, sidecars, tables
from ..sources.corpus import explode_sentences
from ..storage import numbered, percent_ranked, shared_dir

RATE = 8000
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Tables:
    """The tables of one directory, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
    return f


def pairs(t: Tables) -> DataFrame:
    """(conv_id, turn, ref, hyp): each turn with the next."""
    now = t.conversations.select("conv_id", "turn", F.col("text").alias("ref"))
    later = t.conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hyp"))
    return now.join(later, ["conv_id", "turn"])


# Text


@query
def corpus_scan(t: Tables) -> DataFrame:
    return explode_sentences(t.documents, "doc_id", "text")


@query
def normalize_basic(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.normalize_basic(F.col("text")).alias("text"))


@query
def normalize_full(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", tx.normalize_full(F.col("text"), F.col("lang")).alias("text"))


@query
def phoneme_normalize(t: Tables) -> DataFrame:
    c = F.col("text")
    return t.benchmark.select("item_id", tx.phonemes(c).alias("flat"), tx.phonemes_pitch(c).alias("pitch"))


@query
def language_map(t: Tables) -> DataFrame:
    return t.documents.groupBy("lang").agg(F.count("*").alias("docs")).select(
        "lang", tx.language_code(F.col("lang")).alias("code"), "docs"
    )


@query
def diff_tokens(t: Tables) -> DataFrame:
    tokens = tx.diff_tokens(F.col("text"))
    return t.documents.select(
        "doc_id", F.size(tokens).cast("long").alias("n_tokens"), F.md5(F.array_join(tokens, " ")).alias("tokens_md5")
    )


@query
def parse_reason(t: Tables) -> DataFrame:
    made = F.concat(F.lit("wer="), F.col("l_discount").cast("string"), F.lit(" > "), F.col("l_tax").cast("string"))
    reason = F.when(F.col("l_returnflag") == "R", "manual_audit").otherwise(made)
    return t.lineitem.select("l_orderkey", "l_linenumber", reason.alias("reason")).select(
        "*", tx.parse_reason(F.col("reason")).alias("p")
    ).select("l_orderkey", "l_linenumber", "reason", "p.*")


@query
def fingerprint(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", tx.fingerprint(F.col("c_name"), F.col("c_nationkey"), F.col("c_mktsegment")).alias("fingerprint")
    )


@query
def hhmmss(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", tx.hhmmss(F.col("o_totalprice") / 100).alias("duration"))


@query
def bucket_path(t: Tables) -> DataFrame:
    return release.laid_out(t.documents.select("doc_id"), 90, "doc_id")


# Error rates


@query
def wer_pairs(t: Tables) -> DataFrame:
    return gates.word_errors(pairs(t), "ref", "hyp").select("conv_id", "turn", F.round("wer", 6).alias("wer"))


@query
def per_pairs(t: Tables) -> DataFrame:
    return gates.phoneme_errors(pairs(t), "ref", "hyp").select("conv_id", "turn", F.round("per", 6).alias("per"))


@query
def per_pitch_gap(t: Tables) -> DataFrame:
    # what is recognized carries stress marks; the reference has none
    ref, hyp = F.col("ref"), F.replace("hyp", F.lit("an"), F.lit("ˈan"))
    pitch = F.when(
        tx.phonemes_pitch(ref) == "", 0.0
    ).otherwise(align.error_rate(tx.phonemes_pitch(ref), tx.phonemes_pitch(hyp)))
    gap = pitch - align.error_rate(tx.phonemes(ref), tx.phonemes(hyp))
    return pairs(t).select("conv_id", "turn", F.round(gap, 6).alias("gap"))


@query
def wer_gate(t: Tables) -> DataFrame:
    scored = gates.gate(gates.word_errors(pairs(t), "ref", "hyp"), "wer", 0.9, "wer")
    return scored.select(
        "conv_id", "turn", F.round("wer", 6).alias("wer"), "accepted", (F.col("reason") == "").alias("no_reason")
    )


@query
def per_gate(t: Tables) -> DataFrame:
    made = pairs(t).withColumn("idx", F.struct("conv_id", "turn"))
    by_word = tx.zip_phonemes(F.col("ref"), F.array_join(tx.words(F.col("ref")), "\x1f"))
    scored = gates.evaluate(made.select("idx", tx.flat_phonemes(by_word).alias("ref")), made.select("idx", "hyp"), 0.9)
    return scored.select("idx.conv_id", "idx.turn", F.round("per", 6).alias("per"), "accepted")


@query
def wer_running_mean(t: Tables) -> DataFrame:
    scored = gates.word_errors(pairs(t), "ref", "hyp")
    return scored.agg(
        F.round(F.sum("wer"), 4).alias("wer_sum"),
        F.count("wer").alias("wer_count"),
        F.round(gates.mean_or_zero("wer"), 6).alias("mean_wer"),
    )


@query
def align_words(t: Tables) -> DataFrame:
    zipped = F.transform(tx.words(tx.normalize_basic(F.col("ref"))), lambda w: F.struct(w.alias("word"), w.alias("phonemes")))
    made = pairs(t).select(
        "conv_id", "turn", F.posexplode(align.align_words(zipped, tx.normalize_basic(F.col("hyp")))).alias("place", "w")
    )
    return made.select("conv_id", "turn", "place", "w.*")


@query
def word_diff(t: Tables) -> DataFrame:
    steps = align.word_diff(tx.diff_tokens(F.col("ref")), tx.diff_tokens(F.col("hyp")))
    return pairs(t).select("conv_id", "turn", F.posexplode(steps).alias("place", "s")).select("conv_id", "turn", "place", "s.*")


@query
def word_phoneme_zip(t: Tables) -> DataFrame:
    chunks = F.array_join(tx.words(F.col("hyp")), "\x1f")
    made = pairs(t).select("conv_id", "turn", F.posexplode(tx.zip_phonemes(F.col("ref"), chunks)).alias("place", "z"))
    return made.select("conv_id", "turn", "place", "z.*")


# Joins and state


@query
def text_lookup_inner(t: Tables) -> DataFrame:
    clips = t.labels.select((F.col("doc_id") * 2).alias("idx"))
    return clips.join(t.documents.select(F.col("doc_id").alias("idx"), "text"), "idx")


@query
def text_lookup_left(t: Tables) -> DataFrame:
    clips = t.labels.select((F.col("doc_id") * 2).alias("idx"))
    out = clips.join(t.documents.select(F.col("doc_id").alias("idx"), "text"), "idx", "left")
    return out.select("idx", F.coalesce("text", F.lit("")).alias("text"))


@query
def resume_anti_join(t: Tables) -> DataFrame:
    return state.pending(t.documents.select("doc_id", "n_chars"), t.labels, "doc_id")


@query
def only_rejected_semi(t: Tables) -> DataFrame:
    return state.only(t.documents.select("doc_id", "n_chars"), t.labels.filter("quality = 0"), "doc_id")


@query
def normalize_pending(t: Tables) -> DataFrame:
    accepted = state.only(t.documents.select("doc_id", "n_chars"), t.labels.filter("quality = 1"), "doc_id")
    return state.pending(accepted, t.labels.filter("toxic = 1"), "doc_id")


def _clip_scores(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_orderkey").alias("idx")).agg(
        F.max("l_discount").alias("per"), F.max("l_tax").alias("per_pitch")
    )


@query
def audit_join(t: Tables) -> DataFrame:
    x = F.col("embedding")
    features = t.embeddings.select(F.col("vec_id").alias("idx"), F.round(audio.crest(x), 5).alias("crest"))
    texts = t.documents.select(F.col("doc_id").alias("idx"), "text")
    return audit.audit_rows(features, _clip_scores(t), texts).select("idx", "crest", "per", "per_pitch", "text")


@query
def completeness_violations(t: Tables) -> DataFrame:
    return state.incomplete(t.embeddings.select(F.col("vec_id").alias("idx")), _clip_scores(t), "idx")


def _scores(t: Tables, new: bool) -> DataFrame:
    """Old scores of all clips, and new ones of those whose text is toxic or that have no quality yet."""
    rows = t.labels.filter("toxic = 1 OR quality IS NULL") if new else t.labels.filter("quality IS NOT NULL")
    return rows.select("doc_id", (F.col("toxic") + 2 if new else F.col("quality")).alias("per"))


@query
def per_upsert(t: Tables) -> DataFrame:
    return state.upsert(_scores(t, False), _scores(t, True), "doc_id")


@query
def checkpoint_merge(t: Tables) -> DataFrame:
    return state.merge_done(_scores(t, False), _scores(t, True), "doc_id")


@query
def checkpoint_invalidate(t: Tables) -> DataFrame:
    return state.pending(t.labels.select("doc_id"), t.labels.filter("quality = 0"), "doc_id")


@query
def decision_latest(t: Tables) -> DataFrame:
    rows = state.state(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id"], ["ts", "event_id"])
    return rows.select("user_id", "event_type", "event_id")


@query
def state_fold(t: Tables) -> DataFrame:
    rows = state.state(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id"], ["ts", "event_id"])
    return rows.groupBy("event_type").agg(F.count("*").alias("clips"))


@query
def review_progress(t: Tables) -> DataFrame:
    decided = state.state(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id"], ["ts", "event_id"])
    queue = t.customer.select(F.col("c_custkey").alias("user_id"))
    return state.progress(queue, decided, "user_id", ["user_id"], "event_type", "error")


def _sidecars(t: Tables) -> DataFrame:
    """Side files as text, of the kind that the event's type says."""
    k = F.get_json_object("props", "$.k")
    extra = (
        F.when(F.col("event_type") == "click", F.concat(F.lit(', "wer": '), (F.col("event_id") % 100).cast("string")))
        .when(F.col("event_type") == "error", F.lit(', "ref_phonemes": "a b"'))
        .when(F.col("event_type") == "purchase", F.lit(', "audited": true'))
        .otherwise(F.lit(""))
    )
    text = F.concat(F.lit('{"index": '), k, F.lit(', "reason": "'), F.col("event_type"), F.lit('"'), extra, F.lit("}"))
    broken = F.when(F.col("event_id") % 10 == 0, F.lit("{")).otherwise(text)
    return t.events.select("event_id", broken.alias("side"))


@query
def sidecar_parse(t: Tables) -> DataFrame:
    rows = sidecars.parse_sidecars(_sidecars(t), "side")
    return sidecars.named(rows).select("event_id", "index", "reason", "wer", "file")


@query
def sidecar_kind(t: Tables) -> DataFrame:
    rows = sidecars.parse_sidecars(_sidecars(t), "side").withColumn("kind", sidecars.kind())
    return rows.groupBy("kind").agg(F.count("*").alias("files"))


@query
def rejected_queue(t: Tables) -> DataFrame:
    return sidecars.parse_sidecars(_sidecars(t), "side").select("index").distinct()


# Summaries


@query
def calibration_summary(t: Tables) -> DataFrame:
    out = gates.calibration(t.orders, "o_totalprice", 250000.0)
    return out.select("count", *(F.round(c, 4).alias(c) for c in out.columns if c != "count"))


def _word_rows(t: Tables) -> DataFrame:
    per = 1.0 - F.col("quality") + F.col("toxic") * 0.5
    rows = t.documents.join(t.labels, "doc_id")
    return rows.select(F.explode(tx.words(F.col("text"))).alias("word"), per.alias("per"))


@query
def word_stats(t: Tables) -> DataFrame:
    return words.word_stats(_word_rows(t))


@query
def worst_words(t: Tables) -> DataFrame:
    return words.worst_words(words.word_stats(_word_rows(t)), 3)


@query
def one_off_words(t: Tables) -> DataFrame:
    return words.one_off_words(words.word_stats(_word_rows(t)))


@query
def word_summary(t: Tables) -> DataFrame:
    return words.word_summary(words.word_stats(_word_rows(t)), 3)


# Ranks and queues


def _signals(t: Tables) -> DataFrame:
    part = lambda c, n: (c % n) / F.lit(float(n))
    key = F.col("o_orderkey")
    return t.orders.select(
        key.alias("idx"),
        F.col("o_totalprice").alias("per"),
        part(F.col("o_custkey"), 97).alias("per_pitch"),
        part(key * 31, 89).alias("lf_burst"),
        part(key * 7, 101).alias("crest"),
    )


@query
def percentile_rank(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return percent_ranked(rows, {"l_extendedprice": "rank"}).select("l_orderkey", "l_linenumber", F.round("rank", 9).alias("rank"))


@query
def suspect_score(t: Tables) -> DataFrame:
    return audit.scored(_signals(t), audit.COMPOSITE).select("idx", F.round("suspect_score", 6).alias("suspect_score"))


def _queue(by: str) -> Callable[[Tables], DataFrame]:
    def run(t: Tables) -> DataFrame:
        return audit.queue(_signals(t), by).select("idx", F.round("sort_value", 6).alias("sort_value"))

    run.__name__ = f"audit_queue_{by}"
    return run


for _by in ("composite", "per", "pitch", "audio"):
    query(_queue(_by))


@query
def review_queue(t: Tables) -> DataFrame:
    reason = F.when(F.col("o_orderkey") % 5 == 0, "manual").otherwise(
        F.concat(F.lit("per="), (F.col("o_custkey") % 50).cast("string"), F.lit(" > 0.3"))
    )
    rows = t.orders.select(F.col("o_orderkey").alias("idx"), tx.parse_reason(reason)["value"].alias("value"))
    return numbered(rows, ["value", "idx"], "position").select("idx", "value", "position")


@query
def batch_assign(t: Tables) -> DataFrame:
    return release.batched(t.customer.select("c_custkey"), ["c_custkey"], 64)


# Waveforms


@query
def signal_features(t: Tables) -> DataFrame:
    x = F.col("embedding")
    return t.embeddings.select(
        "vec_id",
        F.round(audio.peak(x), 5).alias("peak"),
        F.round(audio.crest(x), 5).alias("crest"),
        F.round(audio.clip_fraction(x), 6).alias("clip_fraction"),
        audio.duration(x, RATE).alias("seconds"),
    )


@query
def peak_normalize(t: Tables) -> DataFrame:
    made = t.embeddings.select("vec_id", F.posexplode(audio.peak_normalize(F.col("embedding"))).alias("place", "sample"))
    return made.select("vec_id", "place", F.round("sample", 5).alias("sample"))


@query
def low_band_ratio(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.round(audio.low_band_ratio(F.col("embedding"), RATE), 6).alias("ratio"))


@query
def trim_interval(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", audio.trim_interval(F.col("embedding")).alias("i")).select("vec_id", "i.*")


# Files


def _clip_files(t: Tables) -> str:
    """A folder of clips, one of each waveform."""
    path = f"{shared_dir(t.spark)}/clips-{uuid.uuid4().hex}"
    rows = t.embeddings.select(F.col("vec_id").alias("idx"), F.col("embedding").alias("samples"), F.lit(RATE).alias("rate"))
    clips.write_clips(rows, path).count()
    return path


@query
def clip_scan(t: Tables) -> DataFrame:
    rows = clips.scan_clips(t.spark, _clip_files(t))
    return rows.select("idx", F.regexp_extract("path", "[^/]+$", 0).alias("file"), F.octet_length("content").alias("bytes"))


@query
def wav_duration(t: Tables) -> DataFrame:
    rows = clips.with_header(clips.scan_clips(t.spark, _clip_files(t)))
    label = tx.seconds_label(F.col("seconds")).alias("label")
    return rows.select("idx", "sample_rate", "channels", "bits", "frames", "seconds", label)


@query
def normalize_clips(t: Tables) -> DataFrame:
    found = clips.scan_clips(t.spark, _clip_files(t))
    return clips.normalize_clips(found, f"{shared_dir(t.spark)}/normalized-{uuid.uuid4().hex}", RATE).select("idx", "outcome", "reason", "seconds")


@query
def per_csv_scan(t: Tables) -> DataFrame:
    path = f"{shared_dir(t.spark)}/per-{uuid.uuid4().hex}"
    idx = F.col("doc_id")
    idx_text = F.when(idx % 7 == 0, F.concat(F.lit("x"), idx.cast("string"))).otherwise(idx.cast("string"))
    per = F.when(idx % 11 == 0, "n/a").when(idx % 13 == 0, "").otherwise(F.format_string("%.4f", F.col("quality") * 0.25))
    pitch = F.format_string("%.4f", F.col("toxic") * 0.5)
    rows = t.labels.select(idx_text.alias("idx"), per.alias("per"), pitch.alias("per_pitch"), F.lit("a b").alias("ref"), F.lit("a|c").alias("hyp"))
    rows.write.csv(path, sep="|", header=True, quote='"', escape='"')
    return tables.read_scores(t.spark, path)


@query
def metadata_scan(t: Tables) -> DataFrame:
    path = f"{shared_dir(t.spark)}/metadata-{uuid.uuid4().hex}"
    lines = t.documents.select("doc_id", tx.collapse(F.col("text")).alias("text")).filter("text <> ''")
    release.write_manifest(release.laid_out(lines, 90, "doc_id"), path)
    return tables.read_metadata(t.spark, path)


# Releases


@query
def train_val_split(t: Tables) -> DataFrame:
    return release.split(t.documents.select("doc_id"), 42, 0.1, "doc_id")


@query
def bucket_representatives(t: Tables) -> DataFrame:
    return release.representatives(release.laid_out(t.documents.select("doc_id"), 90, "doc_id"))


@query
def publish_manifest(t: Tables) -> DataFrame:
    clips = release.split(t.documents.select("doc_id", "text"), 42, 0.1, "doc_id")
    return release.laid_out(clips, 90, "doc_id").select("path", "text", "split")


@query
def next_generation(t: Tables) -> DataFrame:
    return tables.next_generation(t.nation.select(F.format_string("gen%03d", "n_nationkey").alias("name")))


_PRIMARY = "coalesce(lang, '') = 'en'"


def _archives(t: Tables) -> tuple[DataFrame, DataFrame]:
    """All documents as two archives: English, and the rest."""
    columns = F.col("doc_id").alias("idx"), F.col("text")
    return t.documents.filter(_PRIMARY).select(*columns), t.documents.filter(f"NOT ({_PRIMARY})").select(*columns)


@query
def merge_reindex(t: Tables) -> DataFrame:
    return release.reindexed(*_archives(t)).select("idx", "new_idx")


@query
def merge_overlap(t: Tables) -> DataFrame:
    """Texts that documents of the same source share across quality: archives are read by label here."""
    labelled = t.documents.join(t.labels, "doc_id")
    return release.overlap(labelled.filter("quality = 1"), t.documents.join(t.labels.select("doc_id"), "doc_id", "left_anti"))


@query
def merge_integrity(t: Tables) -> DataFrame:
    return release.integrity(t.documents, t.labels, "doc_id")


@query
def merge_archives(t: Tables) -> DataFrame:
    first, second = _archives(t)
    return release.merged(release.split(first, 42, 0.1), second, per_dir=90)


@query
def merge_report(t: Tables) -> DataFrame:
    archive = F.when(F.expr(_PRIMARY), 0).otherwise(1).alias("rank")
    rows = t.documents.join(t.labels, "doc_id").groupBy(archive).agg(
        F.count_if(F.col("quality") == 1).alias("accepted"),
        F.count_if(F.col("quality") == 0).alias("rejected"),
        (F.sum("n_chars") / 16).alias("seconds"),
        F.sum(F.col("toxic") * 2.0).alias("generation_seconds"),
    )
    return release.merged_report(rows.withColumn("model", F.when(F.col("rank") == 0, "en").otherwise("other")))


@query
def report_totals(t: Tables) -> DataFrame:
    kind = F.when(F.col("quality").isNull(), "skipped").when(F.col("quality") == 1, "accepted").otherwise("rejected")
    states = t.documents.join(t.labels, "doc_id", "left").select(kind.alias("state"))
    clips = t.documents.select((F.col("n_chars") / 16).alias("seconds"))
    manifest = release.split(t.documents.select("doc_id"), 42, 0.1, "doc_id")
    out = release.report(states, t.labels.select(F.col("toxic").alias("value")), clips, manifest, 0.3)
    return out.select(
        "totals.input_sentences", "totals.accepted", "totals.rejected", "totals.skipped",
        F.col("quality.mean").alias("mean_per"), "audio.total_duration_seconds", "audio.total_duration_hhmmss",
        "manifest.train", "manifest.val", "manifest.total",
    )
