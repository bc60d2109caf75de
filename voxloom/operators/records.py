"""Contracts of clone records, lists and plans as ordered rules, and where records lie."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import first_error

RATE = 16_000  # samples a second of a clone


def _absent(c: str) -> Column:
    return F.coalesce(F.col(c) == "", F.lit(True))


def clone_error(schema_version: str = "schema_version") -> Column:
    """Why a clone record is unsafe, null if it isn't.

    Columns of the record: status, gen_text, text_id, model, model_signature and generation_config (maps), cloned_audio, ref_audio,
    schema_version, cloned_audio_signature, ref_audio_signature, plan_id, round_id, task_id, speaker_key. Columns of the files, null where
    there is none: wav (the path that is there), wav_rate, wav_frames, wav_signature, ref_signature.
    """
    v = F.col(schema_version)
    signed, planned = v.isin(2, 3), v == 3
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    rules = [(~F.col("status").eqNullSafe("generated"), "status")]
    rules += [(_absent(c), f"missing {c}") for c in ("gen_text", "text_id", "model")]
    rules += [(F.coalesce(F.size(c) <= 0, F.lit(True)), f"missing {c}") for c in ("model_signature", "generation_config")]
    rules += [
        (differs("cloned_audio", "wav") & F.col("wav").isNotNull(), "cloned_audio path mismatch"),
        (F.col("wav").isNull(), "cloned WAV missing"),
        (_absent("ref_audio") | F.col("ref_signature").isNull(), "reference audio missing"),
        (F.col("wav_rate").isNull(), "cloned WAV is unreadable"),
        ((F.col("wav_rate") != RATE) | F.coalesce(F.col("wav_frames") <= 0, F.lit(True)), "cloned WAV rate or length"),
        (signed & differs("cloned_audio_signature", "wav_signature"), "cloned audio signature mismatch"),
        (signed & differs("ref_audio_signature", "ref_signature"), "reference audio signature mismatch"),
    ]
    rules += [(planned & _absent(c), f"missing {c}") for c in ("plan_id", "round_id", "task_id", "speaker_key")]
    return first_error([*rules, (~F.coalesce(v, F.lit(1)).isin(1, 2, 3), "unsupported schema_version")])


def checked(df: DataFrame, error: Column, policy: str = "fail") -> tuple[DataFrame, DataFrame]:
    """(rows without an error, rows with one, in column error). policy: "fail" makes the first table fail as it is read if there is a bad row, "warn" and "skip" leave bad rows out."""
    marked = df.withColumn("error", error)
    bad = marked.where("error is not null")
    if policy not in ("fail", "warn", "skip"):
        raise ValueError(f"unknown policy {policy}")
    if policy != "fail":
        return marked.where("error is null").drop("error"), bad
    ok = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("invalid record: "), F.col("error"))).cast("boolean")).otherwise(True)
    return marked.where(ok).drop("error"), bad


def clone_items(valid: DataFrame) -> DataFrame:
    """wav and sidecar of valid records."""
    return valid.select("wav", F.regexp_replace("wav", r"\.wav$", ".json").alias("sidecar"))


def clone_pairs(valid: DataFrame) -> DataFrame:
    """wav, ref_audio and sidecar of the valid records whose reference is there."""
    return valid.where(~_absent("ref_audio") & F.col("ref_signature").isNotNull()).select("wav", "ref_audio", F.regexp_replace("wav", r"\.wav$", ".json").alias("sidecar"))


def unsafe(path: str | Column) -> Column:
    """Whether a relative path leaves its root: absolute, or with a part ..."""
    p = F.col(path) if isinstance(path, str) else path
    return p.startswith("/") | F.array_contains(F.split(p, "/"), "..")


def output_path(root: str, relative: str | Column) -> Column:
    """Path below a root; fails as it is read where the relative path is unsafe."""
    p = F.col(relative) if isinstance(relative, str) else relative
    return F.when(unsafe(p), F.raise_error(F.concat(F.lit("unsafe path: "), p))).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), p))


def list_errors(paths: DataFrame, inventory: DataFrame, root: str, line: str = "line", path: str = "path") -> DataFrame:
    """paths with error: the first rule that an entry of an ordered list fails (not absolute, outside the root, repeated, not in the inventory); blank lines are left out."""
    rows = paths.withColumn(path, F.trim(path)).where(F.coalesce(F.col(path) != "", F.lit(False)))
    first = rows.groupBy(path).agg(F.min(line).alias("_first"))
    have = inventory.select(F.col(path)).distinct().withColumn("_have", F.lit(True))
    d = rows.join(first, path).join(have, path, "left")
    inside = F.col(path).startswith(root.rstrip("/") + "/") & ~F.array_contains(F.split(path, "/"), "..")
    error = first_error([(~F.col(path).startswith("/"), "not absolute"), (~inside, "outside the root"), (F.col(line) > F.col("_first"), "repeated"), (F.col("_have").isNull(), "not in the inventory")])
    return d.select(line, path, error.alias("error"))


PLAN_FIELDS = ("plan_id", "round_id", "task_id", "speaker_key", "ref_audio", "ref_text", "text_id", "gen_text", "language", "expected_output_relpath", "baseline_duration", "target_duration")


def plan_errors(tasks: DataFrame, plan_id: str, line: str = "line", fields: tuple[str, ...] = PLAN_FIELDS) -> DataFrame:
    """tasks with error: the first rule that a task of a plan fails (C8): a missing field, another plan, a task or an output path that an earlier line has, an unsafe path. First lines are found by partial aggregation, so a value that most lines share is no hot task."""
    d = tasks
    for c, name in (("task_id", "_task"), ("expected_output_relpath", "_out")):
        d = d.join(tasks.where(F.col(c).isNotNull()).groupBy(c).agg(F.min(line).alias(name)), c, "left")
    rules = [(F.col(c).isNull(), f"missing {c}") for c in fields]
    rules += [(F.col("plan_id") != plan_id, "plan_id mismatch"), (F.col(line) > F.col("_task"), "duplicate task_id"), (F.col(line) > F.col("_out"), "duplicate output path"), (unsafe("expected_output_relpath"), "unsafe output path")]
    return d.select(*tasks.columns, first_error(rules).alias("error"))


def mismatched(one: DataFrame, expected: dict[str, object]) -> DataFrame:
    """field, value, expected of the fields of a one-row record (a manifest, a summary, a commit) that differ from what is expected; a missing record differs in all."""
    wants = F.array(*[F.struct(F.lit(k).alias("field"), (F.col(k).cast("string") if k in one.columns else F.lit(None).cast("string")).alias("value"), F.lit(None if v is None else str(v).lower() if isinstance(v, bool) else str(v)).cast("string").alias("expected")) for k, v in expected.items()])
    got = one.limit(1).select(F.explode(wants).alias("w")).select("w.*")
    none = one.sparkSession.createDataFrame([(k, None, None if v is None else str(v)) for k, v in expected.items()], "field string, value string, expected string")
    empty = none.join(F.broadcast(one.limit(1).agg(F.count("*").alias("_n"))), F.lit(True)).where("_n = 0").drop("_n")
    return got.unionByName(empty).where(~F.col("value").eqNullSafe(F.col("expected")))


class Dialect(NamedTuple):
    """How one source lays out its references. markers: any of these in the lower-case path; segment: pattern of the part that names the speaker, with a group for its number ("" takes the folder of the file); dataset and speaker: what they become, with {0} for the part and {1} for its number, pad digits at least. other: (marker in the clone's path, dataset, speaker) that is tried first."""

    markers: tuple[str, ...]
    segment: str
    dataset: str
    speaker: str
    pad: int = 0
    other: tuple[str, str, str] | None = None


# Datasets that are laid out as audio/<dataset>/<speaker>/<file>, and the layouts of the others, in the order of their tests.
CANONICAL = ("childmandarin", "chineseenglishchildren", "king-asr-725", "kingasr612", "speechocean762")
DIALECTS = (
    Dialect(("chinese_english", "children_integrated"), "", "chineseenglishchildren", "chineseenglishchildren_{0}"),
    Dialect(("king-asr-en-kid",), r"^(?i:speaker)(\d+)$", "king-asr-725", "king-asr-725_{0}", other=("King-ASR-612", "kingasr612", "kingasr612_{1}")),
    Dialect(("speechocean762",), r"^(?i:speaker)(\d+)$", "speechocean762", "speechocean762_{1}"),
    Dialect(("baai", "childmandarin"), r"^(\d+)$", "childmandarin", "childmandarin_{1}", pad=3),
)


def speaker_of(ref: str | Column, cloned: str | Column, canonical: tuple[str, ...] = CANONICAL, dialects: tuple[Dialect, ...] = DIALECTS) -> Column:
    """struct(dataset, speaker, stem) of a reference's path: the canonical layout first, then the dialects in order; null where none fits."""
    p, c = (F.col(x) if isinstance(x, str) else x for x in (ref, cloned))
    parts, low = F.split(p, "/"), F.lower(p)
    n = F.size(parts)
    stem = F.regexp_replace(F.try_element_at(parts, F.lit(-1)), r"(?<=.)\.[^.]*$", "")
    folder = F.try_element_at(parts, F.lit(-2))

    def made(dataset: str, speaker: str, part: Column, number: Column) -> Column:
        head, at, tail = speaker.partition("{0}") if "{0}" in speaker else speaker.partition("{1}")
        said = F.concat(F.lit(head), part if at == "{0}" else number, F.lit(tail)) if at else F.lit(head)
        return F.when(said.isNotNull(), F.struct(F.lit(dataset).alias("dataset"), said.alias("speaker"), stem.alias("stem")))

    def read(d: Dialect) -> Column:
        own = folder if not d.segment or d.pad else F.get(F.filter(parts, lambda x: x.rlike(d.segment)), 0)
        number = F.nullif(F.regexp_extract(own, d.segment or "^(.*)$", 1), F.lit(""))
        number = F.when(F.length(F.ltrim(number, F.lit("0"))) < d.pad, F.lpad(F.ltrim(number, F.lit("0")), d.pad, "0")).otherwise(F.ltrim(number, F.lit("0"))) if d.pad else number
        out = made(d.dataset, d.speaker, own, number)
        return F.when(c.contains(d.other[0]), made(*d.other[1:], own, number)).otherwise(out) if d.other else out

    # the first part audio that a canonical dataset and at least a speaker and a file follow
    at = F.filter(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: (n > 2) & (F.get(parts, i - 1) == "audio") & F.get(parts, i).isin(*canonical))
    i = F.get(at, 0)
    usual = F.struct(F.get(parts, i).alias("dataset"), F.get(parts, i + 1).alias("speaker"), stem.alias("stem"))
    out = F.when(F.size(at) > 0, usual)
    for d in dialects:
        hit = F.lit(False)
        for m in d.markers:
            hit = hit | low.contains(m)
        out = out.when(hit, read(d))
    return F.when(p.isNotNull() & (p != "") & (n > 1), out)


def copy_target(root: str, dataset: Column, speaker: Column, ref_stem: Column, wav: Column, task_id: Column) -> Column:
    """Where a chosen clone is copied: named after its reference, and after the first 16 characters of its task, or its own stem without one."""
    stem = F.regexp_replace(F.element_at(F.split(wav, "/"), -1), r"(?<=.)\.[^.]*$", "")
    return F.concat(F.lit(root.rstrip("/") + "/"), dataset, F.lit("/"), speaker, F.lit("/"), ref_stem, F.lit("_clone_"), F.coalesce(F.nullif(F.substring(task_id, 1, 16), F.lit("")), stem), F.lit(".wav"))


def fingerprint(rules: object) -> str:
    """SHA-256 of the canonical JSON of rules or of a configuration."""
    import hashlib
    import json

    return hashlib.sha256(json.dumps(rules, sort_keys=True, ensure_ascii=False, separators=(",", ":"), default=list).encode()).hexdigest()


def eval_items(clips: DataFrame, key: str, text: str, hypothesis: str, language: str, kind: str) -> DataFrame:
    """key, tag_language, ref_normalized, hypo_normalized, substitutions, insertions, deletions, reference_chars, cer, input_fingerprint, hypo_fingerprint of clips with a hypothesis: what an evaluation record of the current rules holds (H9)."""
    from ..functions import edit, normalize
    from ..functions.text import tag_language

    lang = tag_language(text, language, kind)[0]
    d = clips.where(F.col(hypothesis).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(hypothesis).alias("_hypo"), lang.alias("tag_language"))
    d = d.withColumn("ref_normalized", normalize.reference_form("_text", F.col("tag_language"))).withColumn("hypo_normalized", normalize.normalized_safe("_hypo"))
    d = d.withColumn("_x", edit.char_operations("ref_normalized", "hypo_normalized"))
    rate = (F.col("_x.s") + F.col("_x.i") + F.col("_x.d")) / F.nullif(F.col("_x.n"), F.lit(0))
    ops = [F.col(f"_x.{a}").alias(b) for a, b in (("s", "substitutions"), ("i", "insertions"), ("d", "deletions"), ("n", "reference_chars"))]
    return d.select(F.col("_key").alias(key), "tag_language", "ref_normalized", "hypo_normalized", *ops, rate.alias("cer"), F.sha2(F.concat_ws("\0", "_text", "tag_language"), 256).alias("input_fingerprint"), F.sha2("_hypo", 256).alias("hypo_fingerprint"))


def eval_error(tolerance: float = 1e-12) -> Column:
    """The first rule that a stored evaluation fails beside a fresh one, null if it is valid (C5). Stored: cer, substitutions, insertions, deletions, reference_chars, ref_normalized, hypo_normalized; fresh: _ref, _hypo, _s, _i, _d, _n, _cer."""
    bad = lambda c: F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.col(c) < 0)
    ops = lambda *cs: sum((F.col(c) for c in cs[1:]), F.col(cs[0]))
    return first_error([
        (F.col("asr_hypo").isNull() | F.col("ref_normalized").isNull() | F.col("hypo_normalized").isNull(), "missing text"),
        (F.col("ref_normalized") != F.col("_ref"), "reference form"),
        (F.col("hypo_normalized") != F.col("_hypo"), "hypothesis form"),
        (bad("cer") | bad("substitutions") | bad("insertions") | bad("deletions") | bad("reference_chars"), "missing number"),
        ((F.col("ref_normalized") == "") | (F.col("reference_chars") != F.char_length("ref_normalized")), "reference length"),
        (F.abs(F.col("cer") - F.col("_cer")) > tolerance, "rate"),
        (ops("substitutions", "insertions", "deletions") != ops("_s", "_i", "_d"), "operations"),
    ])


def validated(evals: DataFrame, key: str = "wav") -> DataFrame:
    """evals with error: every stored evaluation against one made anew from its own texts. Several shortest alignments may split the same number of operations differently, so their sum is compared."""
    ctx = F.col("reference_normalization_context")
    rows = evals.withColumn("_id", F.monotonically_increasing_id()).withColumn("_lang", ctx["language"]).withColumn("_kind", ctx["lang_type"])
    from ..functions import edit, normalize
    from ..functions.text import tag_language

    d = rows.withColumn("_ref", normalize.reference_form("gen_text", tag_language("gen_text", "_lang", "_kind")[0])).withColumn("_hypo", normalize.normalized_safe("asr_hypo"))
    d = d.withColumn("_x", edit.char_operations("_ref", "_hypo")).select("*", F.col("_x.s").alias("_s"), F.col("_x.i").alias("_i"), F.col("_x.d").alias("_d"), F.col("_x.n").alias("_n"))
    d = d.withColumn("_cer", (F.col("_s") + F.col("_i") + F.col("_d")) / F.nullif(F.col("_n"), F.lit(0)))
    return d.select(*evals.columns, eval_error().alias("error"))


def migrated(evals: DataFrame, key: str = "wav") -> DataFrame:
    """Old evaluations (any version) as rows of the current rules, scored anew from their own texts; rows without a hypothesis stay out (P10)."""
    ctx = F.col("reference_normalization_context")
    return eval_items(evals.withColumn("_lang", ctx["language"]).withColumn("_kind", ctx["lang_type"]), key, "gen_text", "asr_hypo", "_lang", "_kind")
