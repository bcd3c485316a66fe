"""Request scoring as set-at-a-time joins: parse request payloads, explode them,
route each request (payload readable? model present? features present? enough
rows?), score the valid ones, and summarise the batch.

A payload is JSON text: a list of objects, one per feature row.  Objects may
have different keys; the frame of a batch has the union of them as columns, and
a key that an object lacks is null there, as is a value that is no number.

Fixed texts of the serving contract (errors are returned per request):
* "Model for '<asset>' not available"
* "Features list cannot be empty"
* "Validation error: Input data must contain at least <L> rows for LSTM context."
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD_PAYLOAD = "Payload is not a JSON list of objects"
MAX_KEYS = 2000  # columns of a batch's frame


def parse_payloads(requests: DataFrame, payload: str = "payload") -> DataFrame:
    """``requests`` with ``features`` (array<map<string,string>>), null where the text is not a JSON list of objects."""
    text = F.col(payload)
    parsed = requests.withColumn("features", F.from_json(text, "array<map<string,string>>"))
    whole = F.ltrim(text).startswith("[") & ~F.exists("features", lambda m: m.isNull())
    return parsed.withColumn("features", F.when(whole, F.col("features")))


def payload_keys(parsed: DataFrame, max_keys: int = MAX_KEYS) -> list[str]:
    """The union of the keys of all feature rows, sorted: the columns of the batch's frame.

    Keys are made distinct inside each request and by partial aggregation before they
    move; the driver gets at most ``max_keys`` names, and more raise an error.
    """
    own = F.array_distinct(F.flatten(F.transform("features", lambda m: F.map_keys(m))))
    rows = parsed.select(F.explode(own).alias("key")).distinct().orderBy("key").limit(max_keys + 1).collect()
    if len(rows) > max_keys:
        raise ValueError(f"the payloads have more than {max_keys} different keys")
    return [r["key"] for r in rows]


def _number(value: Column) -> Column:
    return value.try_cast("double")


def explode_requests(requests: DataFrame, keys: tuple[str, ...] = ("request_id", "asset_name"),
                     feature_names: tuple[str, ...] | None = None) -> DataFrame:
    """One row per feature map, ``pos`` from 0, and a column per feature name.

    Without ``feature_names`` the columns are the union of the keys.  A request whose
    features are null (an unreadable payload) gives one row with ``payload_error`` and no ``pos``;
    one with an empty list gives none.  A feature named like another column gets underscores after its name.
    """
    names = payload_keys(requests) if feature_names is None else list(feature_names)
    ex = requests.select(*keys, F.col("features").isNull().alias("_bad"), F.posexplode_outer("features").alias("pos", "_m"))
    ex = ex.where(F.col("_bad") | F.col("pos").isNotNull())
    taken, shown = [*keys, "pos", "payload_error"], []
    for n in names:
        free = n
        while free in taken:
            free += "_"
        taken.append(free)
        shown.append(_number(F.col("_m")[n]).alias(free))
    return ex.select(*keys, "pos", *shown, F.when(F.col("_bad"), BAD_PAYLOAD).alias("payload_error"))


def route_requests(requests: DataFrame, served: DataFrame, look_back: int) -> DataFrame:
    """M8 routing: status and error per request, checked in the serving order.

    ``served`` lists the asset names that have a loaded model (small: one row
    per model).  A payload that cannot be read has no rows.  Rows without any
    key make an empty list, however many they are.
    """
    have = served.select("asset_name").distinct().withColumn("_has_model", F.lit(True))
    r = requests.join(have, "asset_name", "left").withColumn("n_rows", F.coalesce(F.size("features"), F.lit(0)))
    no_model = F.format_string("Model for '%s' not available", F.col("asset_name"))
    too_few = F.lit(f"Validation error: Input data must contain at least {look_back} rows for LSTM context.")
    error = (
        F.when(F.col("features").isNull(), F.lit(BAD_PAYLOAD))
        .when(F.col("_has_model").isNull(), no_model)
        .when(F.forall("features", lambda m: F.size(m) == 0), F.lit("Features list cannot be empty"))
        .when(F.col("n_rows") < look_back, too_few)
    )
    return r.select("request_id", "asset_name", "n_rows",
                    F.when(error.isNull(), "ok").otherwise("failed").alias("status"), error.alias("error"))


def batch_summary(routed: DataFrame) -> DataFrame:
    """Total, successful and failed request counts."""
    return routed.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("status") == "ok").alias("successful"),
        F.count_if(F.col("status") != "ok").alias("failed"),
    )


def score_requests(requests: DataFrame, models: DataFrame, look_back: int, price: str = "close") -> DataFrame:
    """M8 with values: routed requests plus the stage-1 forecast of the ok ones.

    ``models``: (asset_name, x_min, x_max, weights) of the served stage-1
    models, one row per model.  The last ``look_back`` prices of
    a request (current row included) are scaled with the model's scaler,
    dotted with its weights in the JVM (``zip_with``/``aggregate``) and
    un-scaled; failed requests keep a null prediction and their error.  A request
    without a price in one of those rows fails too.
    """
    from barline.operators.models import lookback_predict
    from barline.operators.sequences import scale, unscale

    routed = route_requests(requests, models, look_back)
    prices = requests.select("request_id", F.transform("features", lambda m: _number(m[price])).alias("_p"))
    j = routed.join(prices, "request_id", "left").join(models, "asset_name", "left")
    window = F.slice(F.col("_p"), -look_back, look_back)
    scaled = F.transform(window, lambda v: scale(v, F.col("x_min"), F.col("x_max")))
    pred = unscale(lookback_predict(scaled, F.col("weights"), look_back), F.col("x_min"), F.col("x_max"))
    no_price = (F.col("status") == "ok") & F.exists(window, lambda v: v.isNull())
    return j.select(
        "request_id", "asset_name", "n_rows", F.when(no_price, "failed").otherwise(F.col("status")).alias("status"),
        F.when(no_price, f"Prediction failed: '{price}' is missing in the last {look_back} rows").otherwise(F.col("error")).alias("error"),
        F.when(F.col("status") == "ok", pred).alias("prediction"))
