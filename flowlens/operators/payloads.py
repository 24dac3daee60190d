"""Scoring requests as tables: request bodies to rows or errors, and the stable/canary split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.barrier import add_once
from ..functions.hashing import in_share

# Error texts of a request body.
NOT_AN_OBJECT = "JSON body must be an object"
NO_DATA = "Missing 'data' field"
BAD_DATA = "'data' must be an object or a list of objects"


def open_requests(requests: DataFrame, body: str = "body") -> DataFrame:
    """Add `data` (the rows as variants, in order; none for an empty list) and `error`: one of them is null.

    A body is parsed once; after that values stay variants, and kinds are told by casts that leave what lies inside unread.
    """
    parsed = add_once(requests, {"_body": F.try_parse_json(F.col(body))})
    found = {
        "_data": F.try_variant_get("_body", "$.data", "variant"),
        "_list": F.try_variant_get("_body", "$.data", "array<variant>"),
    }
    parsed = add_once(parsed, found)
    rows = F.coalesce("_list", F.array("_data"))
    missing = F.col("_data").isNull() | F.coalesce(F.is_variant_null("_data"), F.lit(False))
    error = (
        F.when(F.col("_data").isNull() & ~is_object(F.col("_body")), F.lit(NOT_AN_OBJECT))
        .when(missing, F.lit(NO_DATA))
        .when(~F.forall(rows, is_object), F.lit(BAD_DATA))
    )
    parsed = add_once(parsed, {"error": error})
    data = F.when(F.col("error").isNull(), rows)
    return parsed.withColumn("data", data).drop("_body", "_data", "_list")


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def row_fields(value: Column, row: T.StructType) -> list[Column]:
    """The fields of a row; a value of another type is cast where it can be, else null."""
    return [F.try_variant_get(value, f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in row]


def request_rows(opened: DataFrame, row: T.StructType, keys: list[str]) -> DataFrame:
    """(keys..., position, row columns...): one row per flow in `data`, given as object or list."""
    found = opened.where("error IS NULL").select(*keys, F.posexplode("data").alias("position", "_row"))
    return found.select(*keys, "position", *row_fields(F.col("_row"), row))


def empty_requests(opened: DataFrame, keys: list[str]) -> DataFrame:
    """Requests with an empty list: neither rows nor an error; their answer is empty."""
    return opened.where("error IS NULL AND size(data) = 0").select(*keys)


def request_errors(opened: DataFrame, keys: list[str]) -> DataFrame:
    return opened.where("error IS NOT NULL").select(*keys, "error")


def canary_share(probability: float | None) -> float:
    return max(0.0, min(1.0, float(probability or 0.0)))


def with_variant(df: DataFrame, key: str, probability: float, seed: int = 42) -> DataFrame:
    """Add `variant`: canary for a repeatable share of keys, else stable."""
    chosen = in_share(seed, F.col(key), canary_share(probability))
    return df.withColumn("variant", F.when(chosen, F.lit("canary")).otherwise(F.lit("stable")))


def model_struct(variant: Column, framework: str, keys: dict[str, str]) -> Column:
    """struct(variant, framework, model_key) of the model that scored a row."""
    model_key = F.when(variant == "canary", F.lit(keys["canary"])).otherwise(F.lit(keys["stable"]))
    return F.struct(variant.alias("variant"), F.lit(framework).alias("framework"), model_key.alias("model_key"))


def score_by_variant(df: DataFrame, scorers: dict, key: str, probability: float, seed: int = 42) -> DataFrame:
    """Each variant's scorer on its own rows; the parts are filters, so nothing is shuffled."""
    routed = with_variant(df, key, probability, seed)
    parts = [scorers[v](routed.where(F.col("variant") == v)) for v in ("stable", "canary")]
    return parts[0].unionByName(parts[1])


#: Rows of a request that are put in order at once.
PART_ROWS = 10_000


def serve_requests(
    requests: DataFrame, row: T.StructType, scorers: dict, framework: str, model_keys: dict[str, str],
    key: str = "request_id", body: str = "body", probability: float = 0.0, seed: int = 42, part_rows: int = PART_ROWS,
) -> DataFrame:
    """(key, predictions, probabilities, model, error): one answer per request, its rows in the order they were sent.

    Scorers add `prediction` and `probabilities`. A request's rows are put in order by parts, which many tasks can do; only
    finished parts come together in the answer. An empty list has an empty answer; a request with an error has nothing
    else. Requests that share a key are answered apart.
    """
    numbered = requests.withColumn("_request", F.monotonically_increasing_id())
    opened = open_requests(numbered, body)
    found = opened.select(key, "_request", "error", F.posexplode_outer("data").alias("position", "_row"))
    rows = found.select(key, "_request", "error", "position", *row_fields(F.col("_row"), row))
    scored = score_by_variant(rows, scorers, key, probability, seed)
    part = F.floor(F.coalesce(F.col("position"), F.lit(0)) / part_rows).cast("int").alias("_part")
    one = F.when(F.col("position").isNotNull(), F.struct("position", "prediction", "probabilities"))
    by = [key, "_request", "variant", "error"]
    parts = scored.groupBy(*by, part).agg(F.sort_array(F.collect_list(one)).alias("_rows"))
    whole = parts.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_part", "_rows"))).alias("_parts"))
    answer = whole.withColumn("_answer", F.flatten(F.transform("_parts", lambda p: p["_rows"])))
    good = F.col("error").isNull()
    return answer.select(
        key,
        F.when(good, F.transform("_answer", lambda a: a["prediction"])).alias("predictions"),
        F.when(good, F.transform("_answer", lambda a: a["probabilities"])).alias("probabilities"),
        F.when(good, model_struct(F.col("variant"), framework, model_keys)).alias("model"),
        "error",
    )
