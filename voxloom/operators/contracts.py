"""Record contracts as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a complete CER row of the current version says of itself.
CER_CONTRACT = {
    "equal": {"eval_schema_version": 4, "stage": "complete", "cer_metric": "char_error_rate", "cer_score_version": 4, "normalization_profile": "safe_tn", "normalization_version": 4},
    "present": ["normalization_fingerprint", "asr_model_fingerprint", "asr_decode_fingerprint"],
    "score": "cer",
}


def first_error(rules: list[tuple[Column, str]]) -> Column:
    """Message of the first rule that is violated (a null condition isn't), null if none is."""
    return F.coalesce(*[F.when(c, m) for c, m in rules])


def meets(contract: dict) -> Column:
    """Whether a row has the contract's values, fingerprints and a finite score that isn't negative."""
    ok = F.lit(True)
    for c, v in contract["equal"].items():
        ok = ok & (F.col(c) == v)
    for c in contract["present"]:
        ok = ok & (F.char_length(c) == 64 if c.startswith("normalization") else F.col(c).isNotNull())
    x = F.col(contract["score"])
    return F.coalesce(ok & ~F.isnan(x) & (x < float("inf")) & (x >= 0), F.lit(False))


# Escapes of Python's json.dumps with ensure_ascii=False.
_ESCAPES = {chr(i): f"\\u{i:04x}" for i in range(32)} | {"\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}


def json_text(c: str) -> Column:
    """A value as Python's json.dumps writes it: texts quoted and escaped, integers and booleans bare, null as null. Fails on other types, whose spelling differs."""
    v = F.col(c).cast("string")
    t = F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    whole = t
    for raw, escaped in _ESCAPES.items():
        whole = F.replace(whole, F.lit(raw), F.lit(escaped))
    t = F.when(v.rlike(r"[\x00-\x1f]"), whole).otherwise(t)
    kind = F.typeof(c)
    text = F.when(kind == "string", F.concat(F.lit('"'), t, F.lit('"'))).when(kind.isin("tinyint", "smallint", "int", "bigint", "boolean"), v).when(kind != "void", F.raise_error(F.concat(F.lit(f"no canonical JSON for {c}: "), kind)).cast("string"))
    return F.coalesce(text, F.lit("null"))


def canonical_json(cols: list[str]) -> Column:
    """JSON object with sorted keys, a blank after commas and colons, nulls kept; as json.dumps(..., ensure_ascii=False, sort_keys=True) gives it."""
    parts = [F.concat(F.lit(f'"{c}": '), json_text(c)) for c in sorted(cols)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def text_id(prefix: str, cols: list[str]) -> Column:
    """The prefix and 16 hex digits of the MD5 of the identity's canonical JSON."""
    return F.concat(F.lit(prefix), F.substring(F.md5(canonical_json(cols)), 1, 16))


def generated_ids(df: DataFrame) -> DataFrame:
    """text_id of each row from the six fields of C12; an empty scenario counts as none."""
    return df.withColumn("scenario", F.nullif("scenario", F.lit(""))).withColumn("text_id", text_id("gen_", ["text", "lang_type", "length_type", "scenario", "subscene", "task_id"]))


def adult_ids(df: DataFrame) -> DataFrame:
    """text_id of each row from the five fields of H20, of which age_tier is always 'adult'."""
    return df.withColumn("age_tier", F.lit("adult")).withColumn("text_id", text_id("adult_", ["text", "lang_type", "scenario", "task_id", "age_tier"]))


def required(df: DataFrame, error: Column, what: str) -> DataFrame:
    """df, failing at run time on the first row that has an error."""
    return df.where(F.when(error.isNotNull(), F.raise_error(F.concat(F.lit(f"{what}: "), error)).cast("boolean")).otherwise(True))


def fresh(df: DataFrame, stat: DataFrame, key: str, signature: str) -> DataFrame:
    """Rows whose stored (size, mtime_ns) still is the file's."""
    s = stat.select(key, F.col("size").alias("_size"), F.col("mtime_ns").alias("_mtime"))
    return df.join(s, key).where((F.col(f"{signature}.size") == F.col("_size")) & (F.col(f"{signature}.mtime_ns") == F.col("_mtime"))).drop("_size", "_mtime")


def unchanged_inputs(evals: DataFrame, clips: DataFrame, key: str, stored: str, parts: list[str]) -> DataFrame:
    """evals whose stored fingerprint is that of the clips' present inputs: the SHA-256 of the parts' canonical JSON (J4). Evaluations of clips that aren't there any more stay out."""
    now = clips.select(key, F.sha2(canonical_json(parts), 256).alias("_now"))
    return evals.join(now, key).where(F.col(stored) == F.col("_now")).drop("_now")
