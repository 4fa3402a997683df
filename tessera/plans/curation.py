"""The curation pipeline: generate, validate, pronounce, normalize, publish, over an append-only log of events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import phonemes
from ..operators import gates, release, state
from ..sources.tables import read_or_empty
from ..storage import written

STEPS = ("generate", "validate", "pronunciation", "normalize", "publish")
EVENTS = "idx long, gen int, step string, outcome string, metric double, threshold double, reason string, seq long"


@dataclass(frozen=True)
class Settings:
    """Thresholds and sizes; callers override what they need."""

    wer_threshold: float = 0.15
    per_threshold: float = 0.30
    phoneme_check: bool = True
    seed: int = 42
    val_ratio: float = 0.1
    wavs_per_dir: int = release.WAVS_PER_DIR

    def __post_init__(self):
        for name in ("wer_threshold", "per_threshold"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} is below 0")
        if not 0 <= self.val_ratio < 1:
            raise ValueError("val_ratio is not between 0 and 1")


def plan(
    steps: tuple[str, ...] = STEPS,
    start: str | None = None,
    settings: Settings = Settings(),
    only_rejected: bool = False,
    calibrate: bool = False,
) -> list[str]:
    """The steps to run, in order, from start; the phoneme step only if it is on.

    Raises on unknown names and on options that no step of the plan takes: only_rejected (generate, validate or
    pronunciation), calibrate (pronunciation), a layout of one's own (publish).
    """
    for name in (*steps, *([start] if start else [])):
        if name not in STEPS:
            raise ValueError(f"unknown step: {name}")
    first = STEPS.index(start) if start else 0
    chosen = [s for s in STEPS[first:] if s in steps and (s != "pronunciation" or settings.phoneme_check)]
    if only_rejected and not {"generate", "validate", "pronunciation"} & set(chosen):
        raise ValueError("no step of the plan works on rejected clips")
    if calibrate and "pronunciation" not in chosen:
        raise ValueError("calibration needs the pronunciation step")
    if settings.wavs_per_dir != release.WAVS_PER_DIR and "publish" not in chosen:
        raise ValueError("a layout needs the publish step")
    return chosen


def last_generation(spark: SparkSession, path: str) -> int | None:
    """The number of the last release under a folder; None where there is none."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return found.agg(F.max("gen")).first()[0]


def resumes(done: int, total: int) -> bool:
    """Whether a workspace is worth resuming: some work is done, not all."""
    return 0 < done < total


class Curation:
    """Steps over a corpus (idx, text). Each reads the log, does what is pending, and appends what came of it.

    synthesize, transcribe and recognize are functions of DataFrames: (idx, text) -> (idx, ...); clips -> (idx,
    transcription); clips -> (idx, ref, hyp). Regenerating a clip raises its gen, which makes all later steps pending
    for it again; nothing in the log is ever changed.
    """

    def __init__(self, spark: SparkSession, corpus: DataFrame, log: str, settings: Settings = Settings()):
        self.spark, self.corpus, self.log, self.settings = spark, corpus, log, settings

    def events(self) -> DataFrame:
        return read_or_empty(self.spark, self.log, EVENTS)

    def latest(self, step: str) -> DataFrame:
        """The last event of each clip in a step, of the clip's last generation alone."""
        rows = state.state(self.events().filter(F.col("step") == step), ["idx"], ["gen", "seq"])
        if step == "generate":
            return rows
        now = self.latest("generate").select("idx", "gen")
        return rows.join(now, ["idx", "gen"], "left_semi")

    def passed(self, step: str) -> DataFrame:
        return self.latest(step).filter("outcome = 'accepted'").select("idx", "gen")

    def append(self, rows: DataFrame, step: str) -> None:
        last = self.events().agg(F.max("seq")).first()[0]
        fields = {"metric": "double", "threshold": "double", "reason": "string"}
        made = rows.withColumns(
            {"step": F.lit(step), "seq": F.lit((last or 0) + 1).cast("long")}
            | {c: F.lit(None).cast(t) for c, t in fields.items() if c not in rows.columns}
        )
        made.select("idx", F.col("gen").cast("int").alias("gen"), "step", "outcome", "metric", "threshold", "reason", "seq").write.mode(
            "append"
        ).parquet(self.log)

    def generate(self, synthesize: Callable[[DataFrame], DataFrame], only_rejected: bool = False) -> None:
        done = self.latest("generate")
        if only_rejected:
            work = self.corpus.join(self.rejected(), "idx").join(done.select("idx", "gen"), "idx")
        else:
            work = state.pending(self.corpus, done, "idx").withColumn("gen", F.lit(0))
        made = synthesize(work.select("idx", "text")).select("idx").withColumn("made_", F.lit(True))
        out = work.select("idx", "gen").join(made, "idx", "left")
        accepted = F.when(F.col("made_"), "accepted").otherwise("skipped")
        self.append(out.select("idx", (F.col("gen") + 1).alias("gen"), accepted.alias("outcome")), "generate")

    def rejected(self) -> DataFrame:
        """Clips of the last generation that a step rejected last."""
        steps = [self.latest(s).filter("outcome = 'rejected'").select("idx") for s in ("validate", "pronunciation")]
        return steps[0].union(steps[1]).distinct()

    def _gated(self, step: str, scored: DataFrame, threshold: float, name: str) -> None:
        out = gates.gate(scored, "metric", threshold, name)
        verdict = F.when(F.col("accepted"), "accepted").otherwise("rejected")
        self.append(
            out.select("idx", "gen", "metric", "reason", verdict.alias("outcome"), F.lit(threshold).alias("threshold")), step
        )

    def validate(self, transcribe: Callable[[DataFrame], DataFrame], again: bool = False) -> None:
        work = self.passed("generate")
        work = state.only(work, self.rejected(), "idx") if again else state.pending(work, self.latest("validate"), "idx")
        clips = work.join(self.corpus, "idx")
        said = clips.join(transcribe(clips).select("idx", "transcription"), "idx", "left")
        scored = gates.word_errors(said, "text", "transcription", "metric")
        self._gated("validate", scored, self.settings.wer_threshold, "wer")

    def pronunciation(self, recognize: Callable[[DataFrame], DataFrame], calibrate: bool = False) -> DataFrame | None:
        """Scores what passed validation. calibrate: returns a summary of the scores and appends nothing."""
        work = self.passed("validate")
        if not calibrate:
            work = state.pending(work, self.latest("pronunciation"), "idx")
        heard = work.join(recognize(work.join(self.corpus, "idx")).select("idx", "ref", "hyp"), "idx")
        # clips without a reference are left out: they stay pending
        scored = gates.phoneme_errors(heard, "ref", "hyp", "metric").filter(F.coalesce(phonemes(F.col("ref")), F.lit("")) != "")
        if calibrate:
            return gates.calibration(written(scored.select("metric"), "heard"), "metric", self.settings.per_threshold)
        self._gated("pronunciation", scored, self.settings.per_threshold, "per")
        return None

    def normalize(self, to_wav: Callable[[DataFrame], DataFrame]) -> None:
        """to_wav: (idx) -> (idx, outcome, reason), as sources.clips.normalize_clips over the clips' contents gives."""
        last = "pronunciation" if self.settings.phoneme_check else "validate"
        work = state.pending(self.passed(last), self.latest("normalize").filter("outcome <> 'failed'"), "idx")
        out = work.join(to_wav(work.select("idx")).select("idx", "outcome", "reason"), "idx")
        self.append(out, "normalize")

    def run(self, models: dict[str, Callable[[DataFrame], DataFrame]], publish_to: str | None = None, **options) -> dict[str, dict[str, int]]:
        """Runs a plan (options: see plan): each step's function is the model of its name. Gives the counts of outcomes of
        each step, of the clips' last generations; publish writes the released clips to a folder.

        A step of the plan without a model raises before anything runs.
        """
        steps = plan(settings=self.settings, **options)
        rejected = options.get("only_rejected", False)
        missing = [s for s in steps if s != "publish" and s not in models] + ["publish"] * ("publish" in steps and not publish_to)
        if missing:
            raise ValueError(f"nothing to run for {', '.join(missing)}")
        counts = {}
        for step in steps:
            if step == "generate":
                self.generate(models[step], only_rejected=rejected)
            elif step == "validate":
                self.validate(models[step], again=rejected and "generate" not in steps)
            elif step == "pronunciation":
                found = self.pronunciation(models[step], options.get("calibrate", False))
                if found is not None:
                    counts[step] = found.first().asDict()
                    break  # a calibration decides on a threshold: later steps wait for it
            elif step == "normalize":
                self.normalize(models[step])
            else:
                clips = self.released()
                release.publish(clips, publish_to, (last_generation(self.spark, publish_to) or 0) + 1, self.settings.wavs_per_dir)
                counts[step] = {"accepted": clips.count()}
                continue
            counts[step] = {r.outcome: r["count"] for r in self.latest(step).groupBy("outcome").count().collect()}
        return counts

    def decide(self, decisions: DataFrame) -> None:
        """Applies decisions (idx, action): keep or bad; the clip's last generation takes them as its validation."""
        now = self.latest("generate").select("idx", "gen")
        verdict = F.when(F.col("action") == "bad", "rejected").otherwise("accepted")
        self.append(decisions.filter("idx >= 0").join(now, "idx").select("idx", "gen", verdict.alias("outcome"), F.lit("manual").alias("reason")), "validate")

    def released(self) -> DataFrame:
        """(idx, text, split, path) of the clips that passed every step which is on."""
        last = "pronunciation" if self.settings.phoneme_check else "validate"
        clips = state.only(self.corpus, self.passed(last), "idx")
        return release.laid_out(release.split(clips, self.settings.seed, self.settings.val_ratio), self.settings.wavs_per_dir)
