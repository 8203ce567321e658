"""Weekly shift sheets -> working calendar -> daily windows -> leads inside / outside them.

The sheet and the calendar are schedule-sized (weeks x staff), independent of
lead volume. Leads never enter a nested-loop join: they meet the windows in a
semi/anti join on (executive, date) with a range condition, the windows side
broadcast behind a row-count check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify_shift, combine, sheet_date, strip
from ..session import scratch_path
from .joins import bounded_broadcast
from .leads import map_executive

DAY_KEY = ["sheet", "row_no", "fecha"]


FILL_ROWS = 65_536                   # row numbers of a sheet that one window covers


def sheet_operator_rows(sheet: DataFrame, fill_rows: int = FILL_ROWS) -> DataFrame:
    """Attach the active week (last header row above) to every operator row.

    A header row holds two dates and a blank third cell. Rows before the
    first header, rows without operator and rows whose shift text has no
    known keyword are dropped. The forward fill goes block by block of row numbers: the last
    header above in the block, or the last one of the blocks before (one row a block), so no
    window spans a whole sheet.
    """
    d0, d1 = sheet_date(F.col("c0")), sheet_date(F.col("c1"))
    blank2 = F.col("c2").isNull() | (F.length(strip(F.col("c2"))) == 0)
    week = F.when(d0.isNotNull() & d1.isNotNull() & blank2, F.struct("row_no", d0.alias("start"), d1.alias("end")))
    s = sheet.withColumn("_week", week).withColumn("_block", F.floor(F.col("row_no") / fill_rows))
    above = Window.partitionBy("sheet", "_block").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("sheet").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (s.groupBy("sheet", "_block").agg(F.max("_week").alias("_last"))
               .select("sheet", "_block", F.last("_last", ignorenulls=True).over(before).alias("_carried")))
    s = s.withColumn("_own", F.last("_week", ignorenulls=True).over(above)).join(carried, ["sheet", "_block"])
    s = s.withColumn("_active", F.coalesce("_own", "_carried"))
    op = strip(F.col("c0"))
    return (
        s.where(F.col("_week").isNull() & F.col("_active").isNotNull())
        .withColumn("operator_raw", op)
        .withColumn("shift", classify_shift(F.col("c2")))
        .where(op.isNotNull() & (F.length(op) > 0) & F.col("shift").isNotNull())
        .select("sheet", "row_no", "operator_raw", "shift", F.col("_active.start").alias("week_start"), F.col("_active.end").alias("week_end"))
    )


def expand_days(ops: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """One row per operator row and day of its week (reversed week -> no rows)."""
    d = ops
    if aliases is not None:
        a = bounded_broadcast(aliases.select(F.col("raw_name").alias("_raw"), F.col("executive").alias("_to")))
        d = d.join(a, F.col("operator_raw") == F.col("_raw"), "left").withColumn(
            "executive", F.coalesce(F.col("_to"), F.col("operator_raw"))).drop("_raw", "_to")
    else:
        d = d.withColumn("executive", F.col("operator_raw"))
    return (
        d.where(F.col("week_start") <= F.col("week_end"))
        .withColumn("fecha", F.explode(F.sequence(F.col("week_start"), F.col("week_end"))))
        .withColumn("weekday", F.weekday(F.col("fecha")))
        .drop("week_start", "week_end")
    )


def apply_rules(days: DataFrame, rules: DataFrame, shifts: DataFrame) -> DataFrame:
    """Hours per day by the lowest-priority matching rule (null rule fields are
    wildcards; executive compared lower-cased); no rule -> the shift's default
    hours; 'off' removes the day; a 'cutoff' date clips the end and drops
    shifts starting at or after the cutoff."""
    rules = bounded_broadcast(rules)                      # once; the hint stays with what is derived below
    prio = rules.where(F.col("action") != "cutoff")
    cut = rules.where(F.col("action") == "cutoff").select(F.col("date").alias("_cdate"), F.col("end").alias("_cut"))
    # A rule names each of executive, date, weekday and shift or leaves it open, so a
    # day meets its rules by equality on 16 key forms (named or open): one hash join.
    named = lambda c: F.concat(F.lit("="), c.cast("string"))
    open_ = F.lit("*")
    days_of = F.when(F.col("weekday_from").isNull() & F.col("weekday_to").isNull(), F.array(open_)).otherwise(F.transform(
        F.sequence(F.coalesce("weekday_from", F.lit(0)), F.coalesce("weekday_to", F.lit(6))), named))
    r = prio.select(
        F.coalesce(named(F.lower("executive")), open_).alias("_ex"), F.coalesce(named(F.col("date")), open_).alias("_d"),
        F.explode(days_of).alias("_w"), F.coalesce(named(F.col("shift")), open_).alias("_sh"),
        F.col("priority").alias("_p"), F.col("action").alias("_a"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    own = [named(F.lower("executive")), named(F.col("fecha")), named(F.col("weekday")), named(F.col("shift"))]
    forms = [F.struct(*[(own[i] if form >> i & 1 else open_).alias(n) for i, n in enumerate(("_ex", "_d", "_w", "_sh"))])
             for form in range(16)]
    matched = days.withColumn("_f", F.explode(F.array(*forms))).select("*", "_f.*").drop("_f").join(r, ["_ex", "_d", "_w", "_sh"], "left")
    keys = DAY_KEY + ["executive", "shift", "weekday"]
    won = matched.groupBy(*keys).agg(
        F.min(F.when(F.col("_p").isNotNull(), F.struct("_p", "_a", "_s", "_e"))).alias("_r"))
    sh = bounded_broadcast(shifts.select(F.col("shift").alias("_shift"), F.col("start").alias("_ds"),
                                         F.col("end").alias("_de")))
    out = won.join(sh, F.col("shift") == F.col("_shift"), "left")
    action = F.coalesce(F.col("_r._a"), F.lit("default"))
    start = F.when(action == "hours", F.col("_r._s")).otherwise(F.col("_ds"))
    end = F.when(action == "hours", F.col("_r._e")).otherwise(F.col("_de"))
    out = (
        out.where(action != "off")
        .withColumn("hora_inicio", start)
        .withColumn("hora_fin", end)
        .where(F.col("hora_inicio").isNotNull() & F.col("hora_fin").isNotNull())
    )
    out = out.withColumn("inicio_dt", combine(F.col("fecha"), F.concat(F.col("hora_inicio"), F.lit(":00")))) \
             .withColumn("fin_dt", combine(F.col("fecha"), F.concat(F.col("hora_fin"), F.lit(":00"))))
    out = out.join(cut, F.col("fecha") == F.col("_cdate"), "left")
    cut_ts = combine(F.col("fecha"), F.concat(F.col("_cut"), F.lit(":00")))
    out = (
        out.where(F.col("_cut").isNull() | (F.col("inicio_dt") < cut_ts))
        .withColumn("hora_fin", F.when(F.col("_cut").isNotNull() & (F.col("fin_dt") > cut_ts), F.col("_cut"))
                    .otherwise(F.col("hora_fin")))
        .withColumn("fin_dt", F.when(F.col("_cut").isNotNull() & (F.col("fin_dt") > cut_ts), cut_ts)
                    .otherwise(F.col("fin_dt")))
    )
    return out.select(*DAY_KEY, "executive", "shift", "hora_inicio", "hora_fin", "inicio_dt", "fin_dt")


def expand_schedule(sheet: DataFrame, rules: DataFrame, shifts: DataFrame,
                    aliases: DataFrame | None = None) -> DataFrame:
    """Sheet -> shift table (fecha, executive, turno, hora_inicio, hora_fin, inicio_dt, fin_dt),
    duplicates on (fecha, executive, inicio_dt, fin_dt) removed, earliest sheet row kept."""
    days = apply_rules(expand_days(sheet_operator_rows(sheet), aliases), rules, shifts)
    keys = ["fecha", "executive", "inicio_dt", "fin_dt"]
    first = days.groupBy(*keys).agg(
        F.min(F.struct("sheet", "row_no", "shift", "hora_inicio", "hora_fin")).alias("_f"))
    return first.select(
        "fecha", "executive", F.col("_f.shift").alias("turno"),
        F.col("_f.hora_inicio").alias("hora_inicio"), F.col("_f.hora_fin").alias("hora_fin"),
        "inicio_dt", "fin_dt",
    )


def sorted_schedule(schedule: DataFrame) -> DataFrame:
    """Sink order of the shift table."""
    return schedule.orderBy("fecha", "inicio_dt", "executive")


def shift_windows(schedule: DataFrame) -> DataFrame:
    """One window per (executive, day): earliest start, latest end."""
    return schedule.groupBy("executive", "fecha").agg(
        F.min("inicio_dt").alias("inicio_dt"), F.max("fin_dt").alias("fin_dt"))


def stored_windows(windows: DataFrame) -> DataFrame:
    """The windows written once to the shared folder: what joins them knows their number from the files and
    does not build the calendar again."""
    path = scratch_path(windows.sparkSession, "windows")
    windows.write.parquet(path)
    return windows.sparkSession.read.schema(windows.schema).parquet(path)


def _lead_keys(leads: DataFrame) -> DataFrame:
    return leads.withColumn("_lead_ts", combine(F.col("in_date"), F.col("in_time")))


def shift_join(leads: DataFrame, windows: DataFrame) -> DataFrame:
    """Leads with their day window (left join on executive and date)."""
    w = bounded_broadcast(windows.select(F.col("executive").alias("_we"), F.col("fecha").alias("_wd"),
                                         "inicio_dt", "fin_dt"))
    return leads.join(w, (F.col("executive") == F.col("_we")) & (F.col("in_date") == F.col("_wd")), "left") \
        .drop("_we", "_wd")


def _in_window_cond():
    return (
        (F.col("executive") == F.col("_we")) & (F.col("in_date") == F.col("_wd"))
        & (F.col("_lead_ts") >= F.col("_ws")) & (F.col("_lead_ts") <= F.col("_wend"))
    )


def _windows_side(windows: DataFrame) -> DataFrame:
    return bounded_broadcast(windows.select(
        F.col("executive").alias("_we"), F.col("fecha").alias("_wd"),
        F.col("inicio_dt").alias("_ws"), F.col("fin_dt").alias("_wend")))


def in_shift(leads: DataFrame, windows: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Leads whose inbound timestamp falls inside their executive's window that day
    (closed interval); original columns only. ``aliases``: the schedule's alias
    table, applied to the leads' executives first."""
    cols = leads.columns
    leads = map_executive(leads, aliases) if aliases is not None else leads
    return _lead_keys(leads).join(_windows_side(windows), _in_window_cond(), "left_semi").select(*cols)


def off_shift(leads: DataFrame, windows: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """The complement of ``in_shift`` (also leads without schedule or inbound time)."""
    cols = leads.columns
    leads = map_executive(leads, aliases) if aliases is not None else leads
    return _lead_keys(leads).join(_windows_side(windows), _in_window_cond(), "left_anti").select(*cols)
