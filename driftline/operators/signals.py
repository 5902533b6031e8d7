"""Per (model, feature) drift signals in batch: adaptive baseline, drift, velocity,
acceleration and their smoothed values, one output row per non-seed value.

Recurrences (x_0 is the first value of a key; t = 1, 2, ... after it):

    m_0 = x_0,  s_0 = max(0.1 |x_0|, 0.01)
    D(x, m) = |x - m|, and 0 if that is at most 1e-9 * max(|x|, |x_0|)
    d_t = 0 if D = 0, 1 if D >= 3 s_{t-1}, else D / s_{t-1} / 3, with D = D(x_t, m_{t-1})
    m_t = 0.01 x_t + 0.99 m_{t-1};   s_t = 0.01 D(x_t, m_t) + 0.99 s_{t-1}
    E_t = 0.1 d_t + 0.9 E_{t-1}  (E_1 = d_1)
    v_t = mean of the differences of the last <= 10 drifts = (d_t - d_max(1,t-9)) / (min(t,10) - 1), t >= 2
    a_t = the same over velocities v_2.., t >= 3;  EV, EA smoothed like E, seeded by the first value
    emitted: drift = round(E,4), velocity = round(EV,6) (0 before t=2),
             acceleration = round(EA,6) (0 before t=3), samples = min(t, 100)

A deviation at rounding level counts as none: after a long run of equal values the
mean differs from them by rounding only, and the ratio of that to a vanishing s would
be noise.  No division by s happens where s may be zero.  Batch, stream and oracle
share this rule.  The mean is scanned centred on the part's first value (exact for
constant features).  Order within a key is (ts, event_id).

Rows are shuffled once, by key, and every step is a window on that (see
:mod:`driftline.operators.ranges`).  Keys with more rows than a task's fair share are cut
into pinned ranges; a cut key takes over, for each step in turn, the value before the
border: one row per range at most.  The lags of nine reach over a border through the last
drifts before it.

A scan may start from a stored state (:func:`key_state`): the state's rows are ranged with
the values, before them, and every step takes over from them as it does over a border.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.numeric import is_finite_value, round_half_even
from driftline.operators.ema import BLOCKS, block_name, ema_in_range, part_window
from driftline.operators.prefix import keyed_positions
from driftline.operators.ranges import (POSITION, RANGE_COL, Border, before_borders, borders, ordered_parts,
                                        with_carry)

KEYS = ["model", "feature"]
ORDER = ["ts", "event_id"]

# Fixed values of the signal engine: baseline adaptation 0.01, smoothing 0.1,
# initial deviation 10 % of |x0| but at least 0.01, z-score scale 3, drift cap 1,
# history of 10 points for velocity / acceleration, sample count capped at 100.
BASE_ALPHA = 0.01
SMOOTH_ALPHA = 0.1
INIT_STD_FRACTION = 0.1
INIT_STD_MIN = 0.01
Z_SCALE = 3.0
# our own: deviations up to this share of max(|x|, |x_0|) count as none
ROUNDING_LEVEL = 1e-9
HISTORY = 10
SAMPLES_CAP = 100

STATE_SCHEMA = ("model string, feature string, t long, x_first double, mc double, s double, e double, ev double, ea double, "
                "recent array<struct<t: bigint, d: double, v: double>>, drift double, velocity double, acceleration double, "
                "ts timestamp_ntz, event_id long")


def explode_features(events: DataFrame, keep_empty: bool = False, also: dict[str, Column] | None = None) -> DataFrame:
    """(event_id, model, ts, features map) -> (event_id, model, ts, fpos, feature, x).

    ``also`` adds columns of the event to its first row (null in the others) and, with it, the
    flag ``leads`` (``keep_empty`` only).

    ``keep_empty`` keeps an event without any usable value as one row with an empty
    feature name and no value, so that it still gets its UNKNOWN prediction.

    ``fpos`` keeps the feature's position in the event (the order the model-level
    means add them in).  NULL / NaN values are quarantined (dropped)."""
    if not keep_empty:
        return events.select("event_id", "model", "ts",
                             F.posexplode("features").alias("fpos", "feature", "x")).where(is_finite_value("x"))
    cells = F.transform(F.map_entries("features"), lambda e, i: F.struct(
        i.alias("fpos"), e["key"].alias("feature"), e["value"].alias("x")))
    usable = F.filter(cells, lambda c: is_finite_value(c["x"]))
    also = also or {}
    cells = events.select("event_id", "model", "ts", *[c.alias(n) for n, c in also.items()],
                          F.posexplode_outer(usable).alias("at", "c"))   # one pass: an empty list gives one row
    leads = F.coalesce(F.col("at"), F.lit(0)) == 0
    more = [leads.alias("leads"), *[F.when(leads, F.col(n)).alias(n) for n in also]] if also else []
    return cells.select("event_id", "model", "ts", F.coalesce("c.fpos", F.lit(0)).alias("fpos"),
                        F.coalesce("c.feature", F.lit("")).alias("feature"), F.col("c.x").alias("x"), *more)


def positions(long: DataFrame, num_ranges: int | None = None) -> DataFrame:
    """Add t (0-based per key in (ts, event_id) order) and x_first."""
    return keyed_positions(long, KEYS, [F.col(c) for c in ORDER], name="t",
                           first_cols=["x"], num_ranges=num_ranges)


def _deviation(gap: Column) -> Column:
    """|gap|, and 0 where it is at rounding level."""
    level = F.greatest(F.abs(F.col("x")), F.abs(F.col("x_first"))) * F.lit(ROUNDING_LEVEL)
    return F.when(F.abs(gap) <= level, F.lit(0.0)).otherwise(F.abs(gap))


def _grown(alpha: float) -> Column:
    """Weight, at a row, of what came before its part."""
    return F.pow(F.lit(1.0 - alpha), (F.col(POSITION) + 1).cast("double"))


def _step_back(column: str, carried: str) -> Column:
    """A column's value one row before, over the border if need be."""
    return F.when(F.col(POSITION) > 0, F.lag(column).over(part_window(KEYS))).otherwise(F.col(carried))


def _local_mean(rows: DataFrame) -> DataFrame:
    upto = part_window(KEYS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_ref", F.first("x", ignorenulls=True).over(upto)).withColumn("_u", F.col("x") - F.col("_ref"))
    return ema_in_range(rows, KEYS, BASE_ALPHA, {"_ml": "_u"}).drop("_u")


def _mean(rows: DataFrame) -> DataFrame:
    """t, x_first and the mean, centred on x_first."""
    rows = _local_mean(rows)
    grown = _grown(BASE_ALPHA)
    rows = rows.withColumn("t", F.when(F.col("x").isNull(), F.lit(0)).otherwise(F.col(POSITION) + F.coalesce("c_t", F.lit(0))))
    rows = rows.withColumn("x_first", F.coalesce("c_x", "_ref"))
    moved = (F.col("_ref") - F.col("x_first")) * (F.lit(1.0) - grown)
    return rows.withColumn("mc", F.col("_ml") + moved + grown * F.coalesce("c_m", F.lit(0.0)))


def _local_spread(rows: DataFrame) -> DataFrame:
    s0 = F.greatest(F.abs(F.col("x_first")) * F.lit(INIT_STD_FRACTION), F.lit(INIT_STD_MIN))
    xc = F.col("x") - F.col("x_first")
    u = F.when(F.col("t") == 0, s0 / F.lit(BASE_ALPHA)).otherwise(_deviation(xc - F.col("mc")))
    return ema_in_range(rows.withColumn("_u", F.when(F.col("x").isNotNull(), u)), KEYS, BASE_ALPHA, {"_sl": "_u"}).drop("_u")


def _spread_and_drift(rows: DataFrame) -> DataFrame:
    rows = _local_spread(rows)
    rows = rows.withColumn("s", F.col("_sl") + _grown(BASE_ALPHA) * F.coalesce("c_s", F.lit(0.0)))
    rows = rows.withColumns({"_mp": _step_back("mc", "c_m"), "_sp": _step_back("s", "c_s")})
    dev = _deviation(F.col("x") - F.col("x_first") - F.col("_mp"))
    ratio = (F.when(dev == 0, F.lit(0.0)).when(dev >= F.lit(Z_SCALE) * F.col("_sp"), F.lit(1.0))
             .otherwise(dev / F.col("_sp") / F.lit(Z_SCALE)))
    return rows.withColumn("d", F.when(F.col("t") >= 1, ratio))


def _slope(rows: DataFrame, value: str, out: str, start: int, carried: str, first: str) -> DataFrame:
    """Mean step of the last <= 10 values of a column that begins at position ``start``."""
    part, lag, t = part_window(KEYS), HISTORY - 1, F.col("t")
    upto = part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({
        "_lag": F.when(F.col(POSITION) >= lag, F.lag(value, lag).over(part))
                 .otherwise(F.try_element_at(F.col(carried), (F.col(POSITION) + 1).cast("int"))),
        "_one": F.coalesce(F.col(first), F.first(F.when(t == start, F.col(value)), ignorenulls=True).over(upto))})
    many = F.least(t - (start - 1), F.lit(HISTORY))
    source = F.when(t >= HISTORY + start - 1, F.col("_lag")).otherwise(F.col("_one"))
    return rows.withColumn(out, F.when(t >= start + 1, (F.col(value) - source) / (many - 1).cast("double"))).drop("_lag", "_one")


def _local_smooth(rows: DataFrame) -> DataFrame:
    rows = _slope(rows, "d", "v", 1, "c_ds", "c_d1")
    rows = _slope(rows, "v", "a", 2, "c_vs", "c_v2")

    def seeded(value: str, start: int) -> Column:  # the first value there is starts the average
        return F.when(F.col("t") == start, F.col(value) / F.lit(SMOOTH_ALPHA)).when(F.col("t") > start, F.col(value)).otherwise(F.lit(0.0))

    rows = rows.withColumns({"_ue": seeded("d", 1), "_uv": seeded("v", 2), "_ua": seeded("a", 3)})
    return ema_in_range(rows, KEYS, SMOOTH_ALPHA, {"_el": "_ue", "_evl": "_uv", "_eal": "_ua"}).drop("_ue", "_uv", "_ua")


def _smooth(rows: DataFrame) -> DataFrame:
    grown = _grown(SMOOTH_ALPHA)
    return _local_smooth(rows).withColumns({out: F.col(own) + grown * F.coalesce(c, F.lit(0.0)) for out, own, c in (
        ("E", "_el", "c_e"), ("EV", "_evl", "c_ev"), ("EA", "_eal", "c_ea"))})


CARRY = ("c_t long, c_x double, c_m double, c_s double, c_ds array<double>, c_vs array<double>, c_d1 double, c_v2 double, "
         "c_e double, c_ev double, c_ea double")
CARRY_NAMES = [c.split()[0] for c in CARRY.replace("array<double>", "array").split(", ")]


def _carry_of_state(state: Column) -> dict[str, Column]:
    """What a stored state hands on, in the terms of a border."""
    lag = HISTORY - 1
    known = F.map_from_arrays(F.transform(state["recent"], lambda r: r["t"]), state["recent"])
    back = F.transform(F.sequence(F.lit(-lag), F.lit(-1)), lambda k: F.try_element_at(known, state["t"] + 1 + k))
    return {"c_t": state["t"] + 1, "c_x": state["x_first"], "c_m": state["mc"], "c_s": state["s"],
            "c_ds": F.transform(back, lambda r: r["d"]), "c_vs": F.transform(back, lambda r: r["v"]),
            "c_d1": F.try_element_at(known, F.lit(1).cast("long"))["d"], "c_v2": F.try_element_at(known, F.lit(2).cast("long"))["v"],
            "c_e": state["e"], "c_ev": state["ev"], "c_ea": state["ea"]}


def _with_carries(rows: DataFrame, found: list[Border], carries: list[dict]) -> DataFrame:
    """The carry columns of every row: from over a border, else from a stored state, else null."""
    if found:
        rows = with_carry(rows, KEYS, found, [tuple(c.get(n) for n in CARRY_NAMES) for c in carries], CARRY)
    else:
        rows = rows.withColumns({n: F.lit(None).cast(k) for n, k in (c.split(" ") for c in CARRY.split(", "))})
    if "_state" not in rows.columns:
        return rows
    upto = part_window(KEYS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_state", F.first("_state", ignorenulls=True).over(upto))
    return rows.withColumns({n: F.coalesce(F.col(n), own) for n, own in _carry_of_state(F.col("_state")).items()})


def _last(rows: DataFrame, *columns: str) -> dict[int, dict]:
    """Columns of the last row of every part before a border: a row per range at most."""
    cols = [F.col(c) for c in columns]
    return {r[RANGE_COL]: r.asDict() for r in rows.where(F.col(POSITION) == F.col("_n") - 1).select(RANGE_COL, *cols).collect()}


def _fold(cut: DataFrame, found: list[Border]) -> list[dict]:
    """What goes over every border, step by step: each step's part-local value of the last
    row, composed with what the part took over itself."""
    carries: list[dict] = [{} for _ in found]

    def taken(k: int) -> dict:
        """What part k took over: from the border before, or from its stored state."""
        return carries[k - 1] if found[k].inner else states.get(found[k].left, {})

    states: dict[int, dict] = {}
    if "_state" in cut.columns:  # at most one state per part before a border
        own = cut.where(F.col("_state").isNotNull()).select(RANGE_COL, *[c.alias(n) for n, c in _carry_of_state(F.col("_state")).items()])
        states = {r[RANGE_COL]: {k: v for k, v in r.asDict().items() if k != RANGE_COL} for r in own.collect()}

    def handed(k: int, **new) -> None:
        # a part without values hands on what it took over
        carries[k].update(new if found[k].rows else {n: taken(k).get(n) for n in new})

    def now() -> DataFrame:
        """The parts before borders, with what they took over so far."""
        inner = [k for k, b in enumerate(found) if b.inner]
        return _with_carries(cut, [found[k - 1] for k in inner], [carries[k - 1] for k in inner])

    ends = _last(_local_mean(cut), "_ref", "_ml")
    for k, b in enumerate(found):
        was, end, q = taken(k), ends.get(b.left, {}), (1.0 - BASE_ALPHA) ** b.rows
        ref = end.get("_ref")
        x0 = was.get("c_x", ref) if was.get("c_x") is not None else ref
        mean = None if ref is None else end["_ml"] + (ref - x0) * (1.0 - q) + q * (was.get("c_m") or 0.0)
        handed(k, c_t=(was.get("c_t") or 0) + b.rows, c_x=x0, c_m=mean)
    ends = _last(_local_spread(_mean(now())), "_sl")
    for k, b in enumerate(found):
        own = ends.get(b.left, {}).get("_sl") or 0.0
        handed(k, c_s=own + (1.0 - BASE_ALPHA) ** b.rows * (taken(k).get("c_s") or 0.0))
    # the last drifts before a border, for the lags of drift and velocity
    reach = 2 * (HISTORY - 1)
    tails: dict[int, dict[int, float]] = {}
    for r in (_spread_and_drift(_mean(now())).where((F.col(POSITION) >= F.col("_n") - reach) & F.col("d").isNotNull())
              .select(RANGE_COL, "t", "d").collect()):
        tails.setdefault(r[RANGE_COL], {})[r["t"]] = r["d"]
    known: list[dict] = []
    for k, b in enumerate(found):
        was = taken(k)
        drifts = dict(known[k - 1]["d"]) if b.inner else _by_position(was, "c_ds", "c_d1", 1)
        rates = dict(known[k - 1]["v"]) if b.inner else _by_position(was, "c_vs", "c_v2", 2)
        drifts.update(tails.get(b.left, {}))
        for t in sorted(tails.get(b.left, {})):
            source = drifts.get(t - HISTORY + 1 if t >= HISTORY else 1)
            if t >= 2 and source is not None:
                rates[t] = (drifts[t] - source) / (min(t, HISTORY) - 1)
        end = carries[k]["c_t"] or 0
        known.append({"d": {t: v for t, v in drifts.items() if t >= end - reach or t == 1},
                      "v": {t: v for t, v in rates.items() if t >= end - reach or t == 2}})
        before = range(end - HISTORY + 1, end)
        carries[k].update(c_ds=[drifts.get(t) for t in before], c_vs=[rates.get(t) for t in before],
                          c_d1=drifts.get(1), c_v2=rates.get(2))
    ends = _last(_local_smooth(_spread_and_drift(_mean(now()))), "_el", "_evl", "_eal")
    for k, b in enumerate(found):
        end, q, was = ends.get(b.left, {}), (1.0 - SMOOTH_ALPHA) ** b.rows, taken(k)
        handed(k, **{c: (end.get(own) or 0.0) + q * (was.get(c) or 0.0) for c, own in (("c_e", "_el"), ("c_ev", "_evl"), ("c_ea", "_eal"))})
    return carries


def _by_position(carry: dict, listed: str, single: str, at: int) -> dict[int, float]:
    """A stored state's last values by position."""
    end, values = carry.get("c_t") or 0, carry.get(listed) or []
    out = {end - len(values) + i: v for i, v in enumerate(values) if v is not None}
    if carry.get(single) is not None:
        out[at] = carry[single]
    return out


def compute_signals(long: DataFrame, num_ranges: int | None = None, keep_state: bool = False,
                    state: DataFrame | None = None) -> DataFrame:
    """All rows (seeds included, t = 0) with m, s, d, E, v, EV, a, EA and the
    rounded outputs.  Seeds carry NULL signal columns.

    ``state`` (see :func:`key_state`) starts its keys where an earlier scan ended.  With
    ``keep_state`` the rows carry what :func:`key_state` needs."""
    rows = long.select("event_id", "model", "ts", "fpos", "feature", "x")
    if state is not None:
        packed = state.select("model", "feature", F.struct(*[c for c in state.columns if c not in KEYS]).alias("_state"))
        rows = rows.withColumn("_state", F.lit(None).cast(packed.schema["_state"].dataType)).unionByName(packed, allowMissingColumns=True)
    rows, cut = ordered_parts(rows, KEYS, ORDER, {block_name(a): n for a, n in BLOCKS.items()}, num_ranges)
    found = borders(rows, KEYS) if cut else []
    carries = _fold(before_borders(rows, KEYS, found), found) if found else []
    rows = _smooth(_spread_and_drift(_mean(_with_carries(rows, found, carries))))
    t = F.col("t")
    rows = rows.withColumns({
        "drift": F.when(t >= 1, round_half_even("E", 4)),
        "velocity": F.when(t >= 2, round_half_even("EV", 6)).when(t == 1, F.lit(0.0)),
        "acceleration": F.when(t >= 3, round_half_even("EA", 6)).when(t >= 1, F.lit(0.0)),
        "samples": F.least(t, F.lit(SAMPLES_CAP)),
        "baseline_mean": F.col("x_first") + F.col("mc"), "baseline_std": F.col("s")})
    keep = ["event_id", "model", "ts", "fpos", "feature", "x", "t", "drift", "velocity",
            "acceleration", "samples", "baseline_mean", "baseline_std"]
    if keep_state:
        rows = rows.withColumn("ending", F.lead("event_id", HISTORY).over(part_window(KEYS)).isNull())
        keep += ["d", "v", "a", "E", "EV", "EA", "x_first", "mc", "s", "ending"]
    if state is not None:
        rows = rows.where(F.col(POSITION) >= 0)
    return rows.select(*keep)


def key_state(all_rows: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The state of every (model, feature) after the rows of a scan with ``keep_state``:
    one row per key, with the last ten drifts and velocities.  ``before`` is the state that
    the scan started from; keys without new rows keep it."""
    last = ["t", "x_first", "mc", "s", "e", "ev", "ea", "drift", "velocity", "acceleration", "ts", "event_id"]
    # of a part only its last rows matter: ten per (range, key)
    ends = all_rows.where("ending AND x IS NOT NULL").select(
        *KEYS, F.array(F.struct("t", "d", "v")).alias("recent"),
        F.struct("t", "x_first", "mc", "s", F.col("E").alias("e"), F.col("EV").alias("ev"), F.col("EA").alias("ea"),
                 "drift", "velocity", "acceleration", "ts", "event_id").alias("last"))
    if before is not None:
        ends = ends.unionByName(before.select(*KEYS, "recent", F.struct(*last).alias("last")))
    found = ends.groupBy(*KEYS).agg(F.max_by("last", F.col("last.t")).alias("last"),
                                    F.sort_array(F.flatten(F.collect_list("recent"))).alias("recent"))
    return found.select(*KEYS, *[F.col(f"last.{c}") for c in last], F.slice("recent", F.greatest(-F.size("recent"), F.lit(-HISTORY)),
                                                                          HISTORY).alias("recent")).select(
        *[c.split()[0] for c in STATE_SCHEMA.replace("array<struct<t: bigint, d: double, v: double>>", "array").split(", ")])


def signal_rows(all_rows: DataFrame) -> DataFrame:
    """The emitted signals table: one row per (event, feature) after the seed."""
    return all_rows.where(F.col("t") >= 1).select(
        "event_id", "model", "feature", "drift", "velocity", "acceleration", "samples", "ts")


def model_state(all_rows: DataFrame) -> DataFrame:
    """Latest state per (model, feature): a key with only its seed shows zeros and
    0 samples; ``feature_count`` is the number of keys of the model."""
    last = all_rows.where("x IS NOT NULL").groupBy(*KEYS).agg(F.max_by(
        F.struct("t", "drift", "velocity", "acceleration", "samples"), F.struct(*ORDER)).alias("s"))
    return shown_state(last)


def shown_state(last: DataFrame) -> DataFrame:
    """(model, feature, s: struct) as the state that a user sees."""
    w = Window.partitionBy("model")
    return last.select(
        "model", "feature",
        F.coalesce(F.col("s.drift"), F.lit(0.0)).alias("drift"),
        F.coalesce(F.col("s.velocity"), F.lit(0.0)).alias("velocity"),
        F.coalesce(F.col("s.acceleration"), F.lit(0.0)).alias("acceleration"),
        F.col("s.samples").cast("long").alias("samples"),
        F.lit(True).alias("initialized"),
        F.count(F.lit(1)).over(w).alias("feature_count"))
