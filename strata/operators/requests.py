"""Planning and checking of ingestion requests.

A request is a row with ``source``, ``entity``, ``run_id`` and a ``params`` map of texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import text as tx
from strata.functions import times as tm
from strata.functions.frames import once, texts

DEFAULT_LIMIT = 1000
WINDOW_MINUTES = 60


def _filled(params: Column, name: str) -> Column:
    """A parameter's value where it is neither null nor empty."""
    value = F.try_element_at(params, F.lit(name))
    return F.when(value != "", value)


def put(params: Column, new: Mapping[str, Column]) -> Column:
    """A map with keys set; map_concat alone refuses keys that are there already."""
    names = list(new)
    kept = F.map_filter(params, lambda k, _: ~k.isin(*names))
    return F.map_concat(kept, F.create_map(*[x for k, v in new.items() for x in (F.lit(k), v.cast("string"))]))


def plan_hourly(
    datasets: DataFrame,
    dates: Sequence[str] | None = None,
    hours: Sequence[int] | None = None,
) -> DataFrame:
    """One request per dataset row, date and hour; no hours means all 24.

    ``datasets`` holds source, entity, endpoint, base ``params`` and, unless ``dates`` is given, date.
    """
    day = F.explode(F.array(*[F.lit(d) for d in dates])) if dates is not None else F.col("date")
    all_hours = F.sequence(F.lit(0), F.lit(23)) if not hours else F.array(*[F.lit(h) for h in hours])
    base = datasets.select("source", "entity", "endpoint", "params", day.alias("date"))
    hourly = base.select("*", F.explode(all_hours).alias("_hour"))
    params = put(
        F.col("params"),
        {"date": F.col("date"), "hour": tx.zero_pad(F.col("_hour")), "endpoint": F.col("endpoint")},
    )
    return once(hourly, "params", params).select("source", "entity", "params")


def requests_with_contract(requests: DataFrame, datasets: DataFrame) -> DataFrame:
    """Requests with the contract of their dataset; ``contract_reason`` says what is missing."""
    known = datasets.withColumn("_known", F.lit(True))
    joined = requests.join(known, ["source", "entity"], "left")
    reason = F.when(F.col("_known").isNull(), F.lit("missing contract")).when(
        ~F.col("has_schema"), F.lit("missing schema")
    )
    return joined.withColumn("contract_reason", reason).drop("_known", "has_schema")


def fill_defaults(
    requests: DataFrame, default_limit: int = DEFAULT_LIMIT, window_minutes: int = WINDOW_MINUTES
) -> DataFrame:
    """Set a page limit and derive the time window where the contract asks for them.

    A null or empty value counts as not given. ``window_reason`` is set where date and hour are
    there and do not name an hour.
    """
    params = F.col("params")

    def asked(name: str, *lists: str) -> Column:
        return F.greatest(F.lit(False), *[F.coalesce(F.array_contains(c, name), F.lit(False)) for c in lists])

    # Each value is looked up once, as a column: repeated in every condition below, the look-ups
    # would make a generated method too large to be compiled.
    names = ("limit", "start_ms", "end_ms", "date", "hour")
    given = F.struct(*[_filled(params, name).alias(name) for name in names])
    wanted = F.struct(
        asked("limit", "placeholders").alias("limit"),
        asked("start_ms", "placeholders", "required").alias("start_ms"),
        asked("end_ms", "placeholders", "required").alias("end_ms"),
    )
    staged = once(once(requests, "_given", given), "_wanted", wanted)
    value = {name: F.col(f"_given.{name}") for name in names}
    lacks = {name: F.col(f"_wanted.{name}") & value[name].isNull() for name in ("limit", "start_ms", "end_ms")}
    derives = (lacks["start_ms"] | lacks["end_ms"]) & value["date"].isNotNull() & value["hour"].isNotNull()
    derived = F.struct(
        lacks["limit"].alias("limit"),
        derives.alias("derives"),
        value["start_ms"].isNull().alias("no_start"),
        value["end_ms"].isNull().alias("no_end"),
        F.when(derives, tm.window_start_ms(value["date"], value["hour"])).alias("start"),
    )
    staged = once(staged, "_d", derived)
    d = {name: F.col(f"_d.{name}") for name in ("limit", "derives", "no_start", "no_end", "start")}
    new = {
        "limit": F.when(d["limit"], F.lit(str(default_limit))),
        "start_ms": F.when(d["no_start"], d["start"].cast("string")),
        "end_ms": F.when(d["no_end"], (d["start"] + window_minutes * 60_000).cast("string")),
    }
    keys = texts(*[F.when(value.isNotNull(), F.lit(name)) for name, value in new.items()])
    staged = once(staged, "_new", F.struct(keys.alias("keys"), texts(*new.values()).alias("texts")))
    new_keys = F.col("_new.keys")
    kept = F.map_filter(params, lambda k, _: ~F.array_contains(new_keys, k))
    filled = F.when(F.size(new_keys) == 0, params).otherwise(
        F.map_concat(kept, F.map_from_arrays(new_keys, F.col("_new.texts")))
    )
    reason = F.when(d["derives"] & d["start"].isNull(), F.lit("date and hour do not name an hour"))
    staged = staged.withColumn("window_reason", reason)
    return once(staged, "params", filled).drop("_given", "_wanted", "_d", "_new")


def default_run_id(source: Column, entity: Column, params: Column, now: str | Column) -> Column:
    """A readable id from date, hour and symbol where all are given, else from the time ``now``."""
    date, hour, symbol = (_filled(params, k) for k in ("date", "hour", "symbol"))
    endpoint = F.coalesce(_filled(params, "endpoint"), entity)
    named = F.concat(date, F.lit("T"), hour, F.lit("-"), source, F.lit("-"), endpoint, F.lit("-"), symbol)
    stamp = F.lit(now) if isinstance(now, str) else now
    return F.coalesce(named, F.concat(stamp, F.lit("-"), source, F.lit("-"), entity))


def with_run_id(requests: DataFrame, now: str | Column, name: str = "run_id") -> DataFrame:
    """Give requests without a run id the default one."""
    made = default_run_id(F.col("source"), F.col("entity"), F.col("params"), now)
    given = F.when(F.col(name) != "", F.col(name)) if name in requests.columns else F.lit(None)
    return requests.withColumn(name, F.coalesce(given, made))


def random_run_id() -> Column:
    """For messages without a run id. Different on every evaluation: write before using it twice."""
    return F.uuid()


def missing_params(names: Column, params: Column) -> Column:
    """Names without a value, sorted. An empty value is a value here."""
    absent = F.filter(names, lambda n: F.try_element_at(params, n).isNull())
    return F.array_sort(F.array_distinct(F.coalesce(absent, F.array().cast("array<string>"))))


def undeclared_placeholders(found: Column, required: Column, optional: Column) -> Column:
    return F.array_sort(F.array_except(found, F.array_union(required, optional)))


def _listing(label: str, names: Column) -> Column:
    return F.when(F.size(names) > 0, F.concat(F.lit(label), F.array_join(names, ",")))


def with_reasons(requests: DataFrame) -> DataFrame:
    """Everything wrong with a request, as ``reasons``; unknown parameters are allowed."""
    params = F.col("params")
    missing = F.struct(
        missing_params(F.col("required"), params).alias("required"),
        missing_params(F.col("placeholders"), params).alias("placeholders"),
    )
    found = once(requests, "_missing", missing)
    checks = [
        F.when(tx.is_blank(F.col("source")), F.lit("blank source")),
        F.when(tx.is_blank(F.col("entity")), F.lit("blank entity")),
        F.when(tx.is_blank(F.col("run_id")), F.lit("blank run_id")),
        F.when(params.isNull(), F.lit("no params")),
        F.when(F.map_contains_key(params, ""), F.lit("empty param key")),
        _listing("missing required: ", F.col("_missing.required")),
        _listing("missing placeholders: ", F.col("_missing.placeholders")),
    ]
    checks += [F.col(c) for c in ("contract_reason", "window_reason") if c in requests.columns]
    return once(found, "reasons", texts(*checks)).drop("_missing")


def validate_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected requests."""
    checked = with_reasons(requests)
    good = checked.where(F.size("reasons") == 0).drop("reasons", "contract_reason", "window_reason")
    return good, checked.where(F.size("reasons") > 0)


def build_requests(requests: DataFrame, datasets: DataFrame, now: str | Column) -> tuple[DataFrame, DataFrame]:
    """Contract lookup, defaults, run ids and validation in one plan."""
    return validate_requests(with_run_id(fill_defaults(requests_with_contract(requests, datasets)), now))


def render_requests(requests: DataFrame) -> DataFrame:
    """The query map of each request with its parameters filled in.

    ``render_missing`` lists, sorted, the names that had no parameter.
    """
    params = F.col("params")
    rendered = F.transform_values("query", lambda _, t: tx.render_template(t, params))
    missing = F.flatten(F.transform(F.map_values("query"), lambda t: tx.missing_template_values(t, params)))
    return requests.withColumns(
        {"rendered": rendered, "render_missing": F.array_sort(F.array_distinct(missing))}
    )
