"""Agreement, fidelity, sampling and measurement bindings."""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from auditloom.functions.text import few


def scored(gold: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Gold rows with their prediction and ``why``, the reason a row can't be scored.

    Gold is the denominator: what nobody annotated is excluded with its reason, not dropped.
    """
    joined = gold.join(predictions.withColumn("_there", F.lit(True)), key, "left")
    why = F.when(F.col("gold").isNull(), "gold_empty").when(F.col("_there").isNull(), "annotator_absent").when(F.col("pred").isNull(), "annotator_blank")
    return joined.withColumn("why", why).drop("_there")


def kappa(rows: DataFrame) -> DataFrame:
    """Coverage, observed and chance agreement and Cohen's kappa of ``gold, pred, why``.

    Rows without a gold label stand outside the count of gold. A kappa that is undefined
    (chance agreement of one) is null and fails.
    """
    ok = rows.where("why IS NULL")
    labelled = F.coalesce(F.col("why") != "gold_empty", F.lit(True))
    n = rows.agg(F.count_if(labelled).alias("n_gold"), F.count_if(F.col("why").isNull()).alias("n_scored"))
    g = ok.groupBy(F.col("gold").alias("v")).agg(F.count("*").alias("g"))
    p = ok.groupBy(F.col("pred").alias("v")).agg(F.count("*").alias("p"))
    chance = g.join(p, "v", "left").agg(F.sum(F.col("g") * F.coalesce("p", F.lit(0))).alias("s"))
    agree = ok.agg(F.count_if(F.col("gold") == F.col("pred")).alias("a"))
    one = n.crossJoin(chance).crossJoin(agree)  # one row each
    po, pe = F.try_divide("a", "n_scored"), F.try_divide(F.col("s"), F.col("n_scored") * F.col("n_scored"))
    one = one.withColumns({"po": po, "pe": pe})
    return one.select("n_gold", "n_scored", F.try_divide("n_scored", "n_gold").alias("coverage"), "po", "pe", F.when(F.col("pe") < 1, (F.col("po") - F.col("pe")) / (1 - F.col("pe"))).alias("kappa"))


def kappa_gate(result: DataFrame, least_kappa: float = 0.70, least_coverage: float = 0.95, allow_zero_coverage: bool = False) -> DataFrame:
    """``result`` with ``reason, verdict, coverage_waived``; a coverage of nothing asked must be waived by name."""
    if not (0 <= least_kappa <= 1 and 0 <= least_coverage <= 1):
        raise ValueError("thresholds lie between 0 and 1")
    disabled = least_coverage == 0 and not allow_zero_coverage
    reason = (
        F.when(F.lit(disabled), "coverage check disabled").when(F.col("n_scored") == 0, "nothing scored").when(F.col("coverage") < least_coverage, "coverage")
        .when(F.col("kappa").isNull() | F.isnan("kappa"), "kappa undefined").when(F.col("kappa") < least_kappa, "kappa")
    )
    waived = F.lit(least_coverage == 0 and allow_zero_coverage)
    return result.withColumn("reason", reason).withColumn("verdict", F.when(F.col("reason").isNull(), "GREEN").otherwise("RED")).withColumn("coverage_waived", waived)


def duplicate_ids(rows: DataFrame, key: str) -> DataFrame:
    """``key, n``: ids that stand more than once; they would weigh a label twice."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def agreement(gold: DataFrame, predictions: DataFrame, key: str, fields: list[str], primary_only: bool = False, **limits) -> DataFrame:
    """``field, n_gold, n_scored, coverage, kappa, reason, verdict``: every field, each by its own kappa.

    ``gold`` and ``predictions`` have the key and the fields. No field, the key as a field, and
    ids that repeat in gold are RED, with their reason. ``primary_only`` lets only the first
    field decide; the others keep their figures and read as ``not gated``. Empty strings are
    missing labels.
    """
    spark, schema = gold.sparkSession, "field string, n_gold long, n_scored long, coverage double, kappa double, reason string, verdict string"
    wanted = [f for f in fields if f]
    if not wanted:
        return spark.createDataFrame([("-", 0, 0, None, None, "no fields to validate", "RED")], schema)
    if key in wanted:
        return spark.createDataFrame([(key, 0, 0, None, None, "the key is no field", "RED")], schema)
    doubled = duplicate_ids(gold, key).agg(F.count("*").alias("_d"))
    filled = lambda df, f, name: df.select(key, F.when(F.col(f).cast("string") != "", F.col(f).cast("string")).alias(name))
    out = None
    for i, f in enumerate(wanted):
        pairs = scored(filled(gold, f, "gold"), filled(predictions, f, "pred").dropDuplicates([key]), key)
        one = kappa_gate(kappa(pairs), **limits).crossJoin(doubled)  # one row each
        reason = F.when(F.col("_d") > 0, "duplicate ids").otherwise(F.col("reason"))
        free = primary_only and i > 0
        verdict = F.lit("not gated") if free else F.when(reason.isNull(), "GREEN").otherwise("RED")
        row = one.select(F.lit(f).alias("field"), "n_gold", "n_scored", F.col("coverage").cast("double").alias("coverage"), F.col("kappa").cast("double").alias("kappa"), reason.alias("reason"), verdict.alias("verdict"))
        out = row if out is None else out.unionByName(row)
    return out


def hash_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The n rows of least seeded hash: the same whatever the partitions."""
    h = F.sha2(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")), 256)
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def sample_design(n: int, pool: int, seed: int, key: str, strata: str | None = None) -> str:
    """What a sample was drawn by, as the JSON of its sidecar."""
    return json.dumps({"n": n, "pool": pool, "seed": seed, "key": key, "strata": strata, "order": "sha256(key:seed)"}, sort_keys=True)


def stratified_sample(df: DataFrame, key: str, strata: str, n: int, seed: int) -> DataFrame:
    """The n rows of least seeded hash in each stratum."""
    h = F.sha2(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")), 256)
    w = Window.partitionBy(strata).orderBy(h, key)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def rater_suite(rows: DataFrame, raters: list[str]) -> DataFrame:
    """``n, po, alpha, fleiss, ac1`` of two or more raters on nominal labels.

    Krippendorff's alpha takes every item that two raters or more have labelled; Fleiss'
    kappa and Gwet's AC1 take the items that all have labelled, ``n`` of them, and ``po`` is
    their observed agreement.
    """
    k = len(raters)
    if k < 2:
        raise ValueError("agreement takes two raters or more")
    labels = F.filter(F.array(*[F.col(r).cast("string") for r in raters]), lambda x: x.isNotNull())
    items = rows.select(labels.alias("_l")).where(F.size("_l") >= 2).withColumn("_m", F.size("_l"))
    # How many ordered pairs of an item's labels agree, by counts of each distinct label.
    same = F.aggregate(F.array_distinct("_l"), F.lit(0), lambda acc, v: acc + F.size(F.filter("_l", lambda x: x == v)) * (F.size(F.filter("_l", lambda x: x == v)) - 1))
    items = items.withColumn("_s", same)
    full = F.col("_m") == k
    agreed = F.col("_s") / (F.col("_m") * (F.col("_m") - 1))
    one = items.agg(F.count_if(full).alias("n"), F.avg(F.when(full, agreed)).alias("po"), F.sum("_m").alias("_all"), F.sum(F.col("_s") / (F.col("_m") - 1)).alias("_ok"))
    pooled = items.select(F.explode("_l").alias("v"), full.alias("f")).groupBy("v").agg(F.count("*").alias("c"), F.count_if("f").alias("c2"))
    sums = pooled.agg(F.sum(F.col("c") * (F.col("c") - 1)).alias("_cc"), F.sum(F.col("c2") * F.col("c2")).alias("_c2"), F.count_if(F.col("c2") > 0).alias("_q"))
    one = one.crossJoin(sums)  # one row each
    expected = 1 - F.try_divide(F.col("_cc"), F.col("_all") * (F.col("_all") - 1))
    observed = 1 - F.try_divide(F.col("_ok"), F.col("_all"))
    chance = F.try_divide(F.col("_c2"), F.col("n") * k * F.col("n") * k)
    gwet = F.try_divide(1 - chance, F.col("_q") - 1)
    return one.select(
        "n", "po", F.when(expected > 0, 1 - observed / expected).alias("alpha"), F.when(chance < 1, (F.col("po") - chance) / (1 - chance)).alias("fleiss"),
        F.when((F.col("_q") > 1) & (gwet < 1), (F.col("po") - gwet) / (1 - gwet)).alias("ac1"),
    )


#: Cells of a grid of attributes; a larger one is a mistake, not a table.
CELLS = 100_000


def rake(cells: DataFrame, margins: dict[str, dict[str, float]], rounds: int = 50) -> list[dict]:
    """Iterative proportional fitting of a small grid of cells to marginals, on the driver; a large grid raises an error."""
    rows = [r.asDict() | {"w": 1.0} for r in cells.limit(CELLS + 1).collect()]
    if len(rows) > CELLS:
        raise ValueError(f"a grid may have {CELLS} cells at most")
    for _ in range(rounds):
        for axis, want in margins.items():
            have: dict = {}
            for r in rows:
                have[r[axis]] = have.get(r[axis], 0.0) + r["w"]
            total = sum(have.values())
            for r in rows:
                r["w"] *= want.get(r[axis], 0.0) * total / have[r[axis]] if have[r[axis]] else 0.0
    return rows


def draw_personas(weighted: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` seeded draws from weighted cells: a number from 0 to the total falls into one cell's stretch of it.

    Cells are a grid that ``rake`` bounds, so their running weights are one array, in which
    draws find their place by bisection.
    """
    spark, cells = weighted.sparkSession, [f for f in weighted.schema.fields if f.name != "w"]
    rows = sorted(weighted.limit(CELLS + 1).collect(), key=lambda r: tuple(repr(r[f.name]) for f in cells))
    if len(rows) > CELLS:
        raise ValueError(f"a grid may have {CELLS} cells at most")
    ends = np.cumsum([float(r["w"]) for r in rows])

    @F.pandas_udf("int")
    def place(u: pd.Series) -> pd.Series:
        return pd.Series(np.minimum(np.searchsorted(ends, u * ends[-1], side="right"), len(ends) - 1))

    grid = spark.createDataFrame([(i, *[r[f.name] for f in cells]) for i, r in enumerate(rows)], StructType([StructField("_i", IntegerType()), *cells]))
    u = F.conv(F.substring(F.sha2(F.concat(F.col("id").cast("string"), F.lit(f":{seed}")), 256), 1, 13), 16, 10).cast("double") / float(16**13)
    return spark.range(n if rows else 0).withColumn("_i", place(u)).join(F.broadcast(grid), "_i").drop("_i")


def fan_out(conditions: DataFrame, personas: DataFrame, items: DataFrame, repetitions: int = 1) -> DataFrame:
    """``custom_id, condition, persona_id, item_id, rep``: every request of a design; nothing is sent.

    Conditions and items are short declared lists, held as two arrays; personas may be many
    and stay where they are.
    """
    lists = few(conditions).agg(F.sort_array(F.collect_list("condition")).alias("_c")).crossJoin(few(items).agg(F.sort_array(F.collect_list("item_id")).alias("_i")))
    rows = personas.select("persona_id").crossJoin(F.broadcast(lists)).withColumn("condition", F.explode("_c")).withColumn("item_id", F.explode("_i"))  # one row
    rows = rows.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(repetitions - 1))))
    return rows.select(F.concat_ws("|", "condition", "persona_id", "item_id", F.concat(F.lit("r"), F.col("rep").cast("string"))).alias("custom_id"), "condition", "persona_id", "item_id", "rep")


def request_estimate(conditions: DataFrame, personas: DataFrame, items: DataFrame, repetitions: int, cost_each: float, cap: float | None = None) -> DataFrame:
    """``n_requests, cost, within_cap`` by counting the lists alone."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    one = n(conditions, "_c").crossJoin(n(personas, "_p")).crossJoin(n(items, "_i"))  # one row each
    total = F.col("_c") * F.col("_p") * F.col("_i") * repetitions
    cost = total * cost_each
    return one.select(total.alias("n_requests"), cost.alias("cost"), (cost <= cap if cap is not None else F.lit(True)).alias("within_cap"))


def fidelity(values: DataFrame, item: str, group: str, value: str, left, right, bins: int = 10, width: float | None = None) -> DataFrame:
    """Per item: mean difference, Kolmogorov-Smirnov distance and Jensen-Shannon divergence of two groups."""
    v = values.where(F.col(group).isin(left, right)).select(F.col(item).alias("item"), (F.col(group) == left).cast("int").alias("l"), F.col(value).cast("double").alias("x"))
    means = v.groupBy("item").agg(F.avg(F.when(F.col("l") == 1, F.col("x"))).alias("ml"), F.avg(F.when(F.col("l") == 0, F.col("x"))).alias("mr"), F.sum("l").alias("nl"), F.sum(1 - F.col("l")).alias("nr"))
    steps = v.groupBy("item", "x").agg(F.sum("l").alias("a"), F.sum(1 - F.col("l")).alias("b"))
    w = Window.partitionBy("item").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    curve = steps.select("item", F.sum("a").over(w).alias("ca"), F.sum("b").over(w).alias("cb")).join(means, "item")
    ks = curve.groupBy("item").agg(F.max(F.abs(F.try_divide("ca", "nl") - F.try_divide("cb", "nr"))).alias("ks"))
    cell = F.floor(F.col("x") / width) if width else F.col("x")
    hist = v.withColumn("bin", cell).groupBy("item", "bin").agg(F.sum("l").alias("a"), F.sum(1 - F.col("l")).alias("b")).join(means, "item")
    p, q = F.try_divide("a", "nl"), F.try_divide("b", "nr")
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    jsd = hist.groupBy("item").agg(F.sum((part(p) + part(q)) / 2).alias("jsd"))
    return means.join(ks, "item").join(jsd, "item").select("item", (F.col("ml") - F.col("mr")).alias("mean_diff"), "ks", "jsd", F.col("nl").cast("long").alias("n_left"), F.col("nr").cast("long").alias("n_right"))


def fidelity_gate(
    values: DataFrame, items: DataFrame, item: str, group: str, value: str, left, right,
    most_mean: float = 0.5, most_ks: float = 0.3, most_jsd: float = 0.1, least_pass: float = 0.8, least_coverage: float = 0.8,
    subgroup: str | None = None, least_r: float = 0.5, allow_missing_subgroup: bool = False,
) -> DataFrame:
    """``items, item_pass_rate, coverage, subgroup_r, reason, verdict`` of simulated (left) against human (right) values.

    ``items`` is what ``fidelity`` gives. An item passes with mean difference, KS and JSD
    within their limits; it is covered where the simulated mean lies within two standard
    errors of the human one. ``subgroup_r`` correlates the means of (item, subgroup); where
    it can't be computed the gate fails unless that is allowed by name.
    """
    v = values.where(F.col(group).isin(left, right)).select(F.col(item).alias("item"), (F.col(group) == left).alias("l"), F.col(value).cast("double").alias("x"), (F.col(subgroup) if subgroup else F.lit(None).cast("string")).alias("s"))
    m = v.groupBy("item").agg(F.avg(F.when(F.col("l"), F.col("x"))).alias("ml"), F.avg(F.when(~F.col("l"), F.col("x"))).alias("mr"), F.stddev_samp(F.when(~F.col("l"), F.col("x"))).alias("sd"), F.count_if(~F.col("l")).alias("nr"))
    inside = m.select("item", F.coalesce(F.abs(F.col("ml") - F.col("mr")) <= 2 * F.col("sd") / F.sqrt("nr"), F.lit(False)).alias("covered"))
    good = (F.abs("mean_diff") <= most_mean) & (F.col("ks") <= most_ks) & (F.col("jsd") <= most_jsd)
    per = items.join(inside, "item").select(F.coalesce(good, F.lit(False)).alias("good"), "covered")
    one = per.agg(F.count("*").alias("items"), F.avg(F.col("good").cast("double")).alias("item_pass_rate"), F.avg(F.col("covered").cast("double")).alias("coverage"))
    cells = v.where("s IS NOT NULL").groupBy("item", "s").agg(F.avg(F.when(F.col("l"), F.col("x"))).alias("a"), F.avg(F.when(~F.col("l"), F.col("x"))).alias("b"))
    pairs = cells.where("a IS NOT NULL AND b IS NOT NULL")
    r = pairs.agg(F.when((F.count("*") > 1) & (F.stddev_samp("a") > 0) & (F.stddev_samp("b") > 0), F.corr("a", "b")).alias("subgroup_r"))
    one = one.crossJoin(r)  # one row each
    reason = (
        F.when(F.col("items") == 0, "no items").when(F.col("item_pass_rate") < least_pass, "item pass rate").when(F.col("coverage") < least_coverage, "coverage")
        .when(F.col("subgroup_r").isNull(), F.lit(None).cast("string") if allow_missing_subgroup else "no subgroup correlation").when(F.col("subgroup_r") < least_r, "subgroup correlation")
    )
    return one.withColumn("reason", reason).withColumn("verdict", F.when(F.col("reason").isNull(), "PASS").otherwise("FAIL"))


def drift(declared: Column, found: Column) -> Column:
    """RED where a constant differs or isn't a finite number; null where it isn't found."""
    bad = F.isnan(declared) | F.isnan(found) | (F.abs(declared) == float("inf")) | (F.abs(declared - found) > 1e-12)
    return F.when(found.isNull(), None).when(bad, "RED").otherwise("GREEN")


def construct_match(instruments: DataFrame, matches: DataFrame) -> DataFrame:
    """Declared instruments against their construct match."""
    j = instruments.join(matches.withColumnRenamed("verdict", "match"), "instrument_id", "left")
    state = F.when(F.col("match").isNull() | (F.col("match") != "MATCH"), "RED").when(F.col("asked").isNull() | F.col("needed").isNull(), "YELLOW").otherwise("GREEN")
    return j.withColumn("state", state)


def design_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Keys of two designs (``key, value``) whose values differ; a key on one side differs."""
    e, a = expected.select("key", F.col("value").alias("expected")), actual.select("key", F.col("value").alias("actual"))
    return e.join(a, "key", "full_outer").where(~F.col("expected").eqNullSafe(F.col("actual")))


def normalise_declarations(raw: DataFrame, wrapper: str) -> DataFrame:
    """A wrapped list, a bare list or a bare object as one row per declaration; else RED.

    ``raw(json)`` to ``declaration, state``.
    """
    kind = F.substring(F.ltrim("json"), 1, 1)
    wrapped = F.get_json_object("json", f"$.{wrapper}")
    body = F.when(kind == "[", F.col("json")).when(wrapped.isNotNull(), wrapped).when((kind == "{") & F.json_object_keys("json").isNotNull(), F.concat(F.lit("["), F.col("json"), F.lit("]")))
    items = F.from_json(body, "array<string>")
    state = F.when(items.isNull(), "RED").otherwise("OK")
    return raw.select(F.explode_outer(items).alias("declaration"), state.alias("state"))


# ---- measurement constants in scripts ----

#: A numeric literal: 1, .62, 1e-3.
NUMBER = r"[-+]?([0-9]+(\.[0-9]+)?|\.[0-9]+)([eE][-+]?[0-9]+)?"
# Endings that mark a constant as one of measurement.
MEASURED = "RECALL|PRECISION|_SE|_SP|SENS|SPEC|KAPPA|ACCURACY|_RATE|_FPR|_FNR"


def assignments(scripts: DataFrame, key: str = "script", text: str = "text") -> DataFrame:
    """``key, name, value``: numeric assignments of scripts, comments left out, each name's first."""
    body = F.regexp_replace(text, r"#[^\n]*", "")
    pattern = rf"(?m)(^|[^A-Za-z0-9_.])([A-Za-z_.][A-Za-z0-9_.]*)[ \t]*(<-|=)[ \t]*({NUMBER})"
    pairs = F.arrays_zip(F.regexp_extract_all(body, F.lit(pattern), F.lit(2)).alias("name"), F.regexp_extract_all(body, F.lit(pattern), F.lit(4)).alias("value"))
    found = scripts.select(key, F.posexplode(pairs).alias("at", "p")).select(key, "at", F.col("p.name").alias("name"), F.col("p.value").cast("double").alias("value"))
    return found.groupBy(key, "name").agg(F.min_by("value", "at").alias("value"))


def constant_drift(declared: DataFrame, scripts: DataFrame) -> DataFrame:
    """``declared(name, script, value)`` with ``state, reason`` against what scripts hold."""
    found = assignments(scripts).withColumnRenamed("value", "_found")
    known = scripts.select("script").distinct().withColumn("_known", F.lit(True))
    rows = declared.join(known, "script", "left").join(found, ["script", "name"], "left")
    v = F.col("value")
    reason = (
        F.when(F.col("name").isNull() | F.col("script").isNull(), "malformed declaration").when(F.col("_known").isNull(), "script not found")
        .when(F.col("_found").isNull(), "no assignment").when(F.isnan(v) | (F.abs(v) == float("inf")), "not finite").when(F.abs(F.col("_found") - v) > 1e-12, "drift")
    )
    return rows.withColumn("reason", reason).withColumn("state", F.when(F.col("reason").isNull(), "GREEN").otherwise("RED")).drop("_known", "_found")


def undeclared_literals(scripts: DataFrame, declared: DataFrame) -> DataFrame:
    """Constants that look like measurement and aren't declared."""
    looks = assignments(scripts).where(F.col("name").rlike(rf"^[A-Z][A-Z0-9_]*({MEASURED})$"))
    return looks.join(declared.select("name").distinct(), "name", "left_anti")


#: The version of a validation report that this engine writes and reads.
REPORT_VERSION = 2


def report_json(fields: DataFrame, instrument_id: str | None = None, waived: bool = False) -> DataFrame:
    """``report``: one strict JSON of the fields' figures; what is no number is null, never NaN."""
    plain = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    numbers = {f.name for f in fields.schema.fields if f.dataType.simpleString() == "double"}
    rows = fields.select(F.struct(*[plain(c) if c in numbers else F.col(c) for c in fields.columns]).alias("f"))
    listed = rows.agg(F.sort_array(F.collect_list("f")).alias("fields"))
    instrument = F.struct(F.lit(instrument_id is not None).alias("declared"), F.lit(waived).alias("waived"), F.lit(instrument_id).alias("instrument_id"))
    body = F.struct(F.lit(REPORT_VERSION).alias("schema_version"), F.col("fields"), instrument.alias("instrument"))
    return listed.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("report"))


def report_problem(report: Column) -> Column:
    """Why a report can't be used, or null: not strict JSON, another version, no fields."""
    version = F.get_json_object(report, "$.schema_version")
    return (
        F.when(F.json_object_keys(report).isNull() | report.rlike(r"[:\[,]\s*-?(NaN|Infinity)"), "not strict JSON").when(~F.coalesce(version == str(REPORT_VERSION), F.lit(False)), "another version")
        .when(F.coalesce(F.json_array_length(F.get_json_object(report, "$.fields")), F.lit(0)) == 0, "no fields")
    )


def instrument_state(reports: DataFrame) -> DataFrame:
    """``reports(report, json)``: an instrument declared, waived (YELLOW) or absent (RED).

    Only JSON booleans count; the string "true" declares nothing.
    """
    schema = "instrument struct<declared:boolean,waived:boolean,instrument_id:string>"
    i = F.from_json("json", schema)["instrument"]
    reason = (
        F.when(F.json_object_keys("json").isNull(), "unreadable").when(i.isNull(), "no instrument")
        .when(i["declared"], F.when(F.coalesce(i["instrument_id"], F.lit("")) == "", "no id")).when(i["waived"], "waived").otherwise("not declared")
    )
    state = F.when(F.col("reason").isNull(), "GREEN").when(F.col("reason") == "waived", "YELLOW").otherwise("RED")
    return reports.select("report", i["instrument_id"].alias("instrument_id"), reason.alias("reason")).withColumn("state", state)


def without_record(instruments: DataFrame, matches: DataFrame) -> DataFrame:
    """Declared instruments that no construct match mentions."""
    return instruments.select("instrument_id").where("instrument_id IS NOT NULL").distinct().join(matches, "instrument_id", "left_anti")


def combined_verdict(findings: DataFrame, discovered: int) -> DataFrame:
    """``findings(state)``: INERT only where nothing was discovered and nothing found."""
    red, yellow = F.count_if(F.col("state") == "RED"), F.count_if(F.col("state") == "YELLOW")
    verdict = F.when(red > 0, "RED").when(yellow > 0, "YELLOW").otherwise("INERT" if discovered == 0 else "GREEN")
    return findings.agg(red.alias("red"), yellow.alias("yellow"), verdict.alias("verdict"))


# ---- intervals of agreement ----


def poisson_weight(key: Column, replicate: Column, seed: int = 42) -> Column:
    """How often a replicate of a bootstrap takes a row: a Poisson number of mean one, by a hash of the row's key, the replicate and the seed.

    The hash gives a number below 2^32, and the count is how many of the distribution's steps
    it has passed; the ninth is beyond 32 bits.
    """
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), replicate.cast("string"), key.cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")
    return sum((F.when(h >= step, 1).otherwise(0) for step in POISSON_STEPS), F.lit(0)).cast("long")


#: The distribution of a Poisson number of mean one, up to each count, of 2^32.
POISSON_STEPS = [round((1 << 32) * math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1))) for k in range(9)]


def agreement_intervals(rows: DataFrame, key: str, a: str, b: str, replicates: int = 200, level: float = 0.95, seed: int = 42) -> DataFrame:
    """``measure, estimate, low, high, n``: Cohen's kappa and Krippendorff's alpha of two raters, with bootstrap intervals.

    One pass: a row adds its weight in every replicate to the count of its pair of labels, and
    what moves is a count per pair of labels and replicate. The interval runs between the
    replicates' quantiles; a replicate in which a measure is undefined doesn't count, and an
    undefined estimate has neither. Rows that lack a label or a key stand outside; rows of one
    key are taken together.
    """
    pairs = rows.where(F.col(key).isNotNull() & F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(key).alias("k"), F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
    # Replicate 0 is the sample itself.
    dealt = pairs.select("k", "a", "b", F.explode(F.sequence(F.lit(0), F.lit(replicates))).alias("r"))
    weight = F.when(F.col("r") == 0, 1).otherwise(poisson_weight(F.col("k"), F.col("r"), seed))
    cells = dealt.groupBy("r", "a", "b").agg(F.sum(weight).alias("w"))
    agreed = cells.groupBy("r").agg(F.sum("w").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("w")).otherwise(0)).alias("same"))
    side = lambda c, out: cells.groupBy("r", F.col(c).alias("v")).agg(F.sum("w").alias(out))
    ends = side("a", "wa").join(side("b", "wb"), ["r", "v"], "full_outer").na.fill(0, ["wa", "wb"])
    both = F.col("wa") + F.col("wb")
    chance = ends.groupBy("r").agg(F.sum(F.col("wa") * F.col("wb")).alias("pe"), F.sum(both * (both - 1)).alias("cc"))
    n, po = F.col("n").cast("double"), F.try_divide("same", "n")
    pe = F.try_divide(F.col("pe"), n * n)
    expected = 1 - F.try_divide(F.col("cc"), 2 * n * (2 * n - 1))
    by = agreed.join(chance, "r").select("r", "n", F.when(pe < 1, (po - pe) / (1 - pe)).alias("kappa"), F.when(expected > 0, 1 - (1 - po) / expected).alias("alpha"))
    long_ = by.select("r", "n", F.explode(F.create_map(F.lit("kappa"), F.col("kappa"), F.lit("alpha"), F.col("alpha"))).alias("measure", "x"))
    tail = (1 - level) / 2
    own = lambda c: F.max(F.when(F.col("r") == 0, F.col(c)))
    out = long_.groupBy("measure").agg(own("x").alias("estimate"), F.expr(f"percentile(IF(r > 0, x, NULL), {tail!r})").alias("low"), F.expr(f"percentile(IF(r > 0, x, NULL), {1 - tail!r})").alias("high"), own("n").alias("n"))
    known = F.col("estimate").isNotNull()
    return out.select("measure", "estimate", F.when(known, F.col("low")).alias("low"), F.when(known, F.col("high")).alias("high"), "n")
