"""Site x group pivots, the multi-grain sheet set and the state x month report.

Pivots are computed long first (one aggregate for the group cells and the
true per-site totals), then turned wide by one conditional aggregate over an
explicit value list, so every sheet has the same columns, no job discovers
them and nothing is joined back.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import REPORT_STATES, WEEKLY_SHEET_MONTHS, PillarSpec
from ..functions.calendar import month_label, month_start, quarter_sheet, quarter_start
from ..functions.classify import classify
from ..functions.text import contains_or_false, non_empty
from ..session import first_partitions
from .joins import densify_left, densify_outer
from .rollups import site_dimension


def slug(value: str) -> str:
    """Column-safe name for a pivot value."""
    return re.sub(r"\W+", "_", str(value)).strip("_") or "blank"


def column_names(groups: list[str]) -> list[str]:
    """A distinct column prefix for each group: a slug that is taken gets a
    number."""
    out: list[str] = []
    for g in groups:
        name, n = slug(g), 2
        while name in out or name == "total":
            name, n = f"{slug(g)}_{n}", n + 1
        out.append(name)
    return out


def wide_columns(groups: list[str]) -> list[str]:
    return [f"{n}_{m}" for n in [*column_names(groups), "total"] for m in ("events", "pax")]


TOTAL = "total"
CELL = "cell"
LISTED = "listed"


def _long(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct events and participants of (keys, kind, grp).  Each row is
    emitted once for its cell and once for the total, then a plain GROUP BY
    runs the distinct counts (grouping sets with distinct aggregates expand
    the rows twice)."""
    return (tagged.groupBy(*keys, "kind", "grp")
                  .agg(F.count_distinct("event_id").cast("bigint").alias("events"),
                       F.count_distinct("participant_id").cast("bigint").alias("pax")))


def _tag(kind: str, group=None):
    return F.struct(F.lit(kind).alias("kind"), (F.lit(None) if group is None else group).cast("string").alias("grp"))


def _wide(long: DataFrame, keys: list[str], groups: list[str]) -> DataFrame:
    """One row per key: a column pair for each group (zero without a cell)
    and the total, all picked from the long rows in one aggregate."""
    aggs = []
    for g, name in zip(groups, column_names(groups), strict=True):
        hit = (F.col("kind") == CELL) & (F.col("grp") == g)
        aggs += [F.coalesce(F.max(F.when(hit, F.col(m))), F.lit(0)).alias(f"{name}_{m}") for m in ("events", "pax")]
    total = F.col("kind") == TOTAL
    aggs += [F.coalesce(F.max(F.when(total, F.col(m))), F.lit(0)).alias(f"total_{m}") for m in ("events", "pax")]
    return long.groupBy(*keys).agg(*aggs, F.max(F.col("kind") == CELL).alias("_any"))


def _home_pivot(fact: DataFrame, sites: DataFrame, programs: list[str], site_col: str, program_col: str,
                sheets: list) -> DataFrame:
    """Cells by home site for each of the sheet structs of a row; a site's
    total counts all its participant rows, but only where it has a
    programmed row (else 0)."""
    pax = fact.where(F.col("participant_id").isNotNull() & non_empty(site_col))
    tags = F.array_compact(F.array(F.when(non_empty(program_col), _tag(CELL, F.col(program_col))), _tag(TOTAL)))
    rows = pax.select(F.col(site_col).alias("refid"), "event_id", "participant_id", tags.alias("_t"),
                      F.explode(F.array_compact(F.array(*sheets))).alias("_s"))
    tagged = rows.select("refid", "event_id", "participant_id", "_s.*", F.explode("_t").alias("_t")).select(
        "refid", "event_id", "participant_id", "grain_code", "sheet_start", "wom", "_t.kind", "_t.grp")
    keys = ["grain_code", "sheet_start", "wom", "refid"]
    return _wide(_long(tagged, keys), keys, programs).where("_any").drop("_any")


def pivot_wide_home(fact: DataFrame, sites: DataFrame, programs: list[str], site_col: str = "home_refid",
                    program_col: str = "program") -> DataFrame:
    """Site x program pivot keyed by the participant's home site.

    Program cells use rows with a program; ``total_*`` are distinct over all
    participant rows of the site, but only for sites with at least one
    programmed row (else 0).  Every site of the dimension is present; home
    sites outside it are dropped.
    """
    wide = _home_pivot(fact, sites, programs, site_col, program_col, [_sheet(4)]).drop("grain_code", "sheet_start", "wom")
    dim = site_dimension(sites).select("refid", "site_name", "state")
    cols = wide_columns(programs)
    return densify_left(dim, wide, ["refid"], cols).select("refid", "site_name", "state", *cols)


def monthly_home_pivot(fact: DataFrame, sites: DataFrame, programs: list[str], site_col: str = "home_refid",
                       program_col: str = "program", date_col: str = "event_startdate") -> DataFrame:
    """The home-site pivot of each month with activity and of All, with the
    same program columns; every site of the dimension is on every sheet, and
    a site's total follows the rule of :func:`pivot_wide_home` by sheet."""
    month = F.when(F.col(date_col).isNotNull(), _sheet(1, month_start(date_col)))
    wide = _home_pivot(fact, sites, programs, site_col, program_col, [month, _sheet(4)])
    cols = wide_columns(programs)
    # The sheets that the cells have, as one array (one entry a month, and All).
    sheets = wide.agg(F.collect_set(F.struct(*SHEET))).scalar()
    dim = site_dimension(sites).select("refid", "site_name", "state")
    grid = dim.select("*", F.explode(sheets).alias("_s")).select("_s.*", "refid", "site_name", "state")
    same = (grid["refid"] == wide["refid"]) & (grid["grain_code"] == wide["grain_code"]) & grid["sheet_start"].eqNullSafe(wide["sheet_start"])
    out = grid.join(wide.drop("wom"), same, "left")
    return sheet_labels(out.select(grid["grain_code"], grid["sheet_start"], grid["wom"], grid["refid"], "site_name", "state",
                                   *[F.coalesce(c, F.lit(0)).alias(c) for c in cols]))


def unique_fact_sites(fact: DataFrame, refid: str = "event_site_refid", name: str = "event_site_name",
                      state: str = "event_site_state") -> DataFrame:
    """Distinct (refid, name, state) of the fact with a non-empty refid, by
    state and name."""
    return (fact.select(F.col(refid).alias("refid"), F.col(name).alias("site_name"), F.col(state).alias("state"))
                .distinct().where(non_empty("refid")).orderBy(F.col("state").asc_nulls_last(), F.col("site_name").asc_nulls_last(), "refid"))


def pivot_wide_group(fact: DataFrame, group_col: str, groups: list[str], keep=None, all_sites: DataFrame | None = None,
                     site_cols=("event_site_refid", "event_site_name", "event_site_state")) -> DataFrame:
    """Site x group pivot keyed by the event site.

    Rows outside ``groups``, rows that ``keep`` (a condition) leaves out and
    rows with a null key part make no cell, so the totals are after the
    filter.  Listed with zeros besides: the rows of ``all_sites``, or else
    every (refid, name, state) of ``fact`` with a refid."""
    keys = ["refid", "site_name", "state"]
    refid, name, state = site_cols
    rows = fact.where(non_empty(refid))
    counted = F.col(group_col).isin(*groups) & F.col(name).isNotNull() & F.col(state).isNotNull()
    counted = F.coalesce(counted if keep is None else counted & keep, F.lit(False))
    tags = F.explode(F.when(counted, F.array(_tag(CELL, F.col(group_col)), _tag(TOTAL))).otherwise(F.array(_tag(LISTED))))
    rows = rows if all_sites is None else rows.where(counted)
    tagged = rows.select(F.col(refid).alias("refid"), F.col(name).alias("site_name"), F.col(state).alias("state"),
                         "event_id", "participant_id", tags.alias("_t")).select(*keys, "event_id", "participant_id", "_t.kind", "_t.grp")
    wide = _wide(_long(tagged, keys), keys, groups).drop("_any")
    cols = wide_columns(groups)
    if all_sites is not None:
        wide = densify_outer(all_sites.select(*keys), wide, keys, cols)
    return wide.select(*keys, *cols)


# ---------------------------------------------------------------------------
# Multi-grain sheet set
# ---------------------------------------------------------------------------

def _pillar_group(pillars: list[PillarSpec]):
    expr = None
    for p in pillars:
        g = classify(p.group_col, p.classifier) if p.classifier else F.col(p.group_col)
        cond = F.col("pillar_name") == p.name
        expr = F.when(cond, g) if expr is None else expr.when(cond, g)
    return expr


def _pillar_keep(pillars: list[PillarSpec]):
    keep = F.lit(False)
    for p in pillars:
        c = F.col("pillar_name") == p.name
        if p.groups:
            c = c & F.col("grp").isin(*p.groups)
        keep = keep | c
    return keep


GRAIN_CODES = {1: "month", 2: "quarter", 3: "week", 4: "all"}


def _week_of_month_no(d):
    """1..4 for the (0,7] (7,14] (14,21] (21,31] day bins."""
    day = F.dayofmonth(d)
    return F.when(day <= 7, 1).when(day <= 14, 2).when(day <= 21, 3).when(day <= 31, 4)


def _sheet(code: int, start=None, wom=None):
    """A sheet's compact key: grain code, start date, week-of-month number.
    :func:`sheet_labels` makes the texts after aggregation, so the heavy
    GROUP BY hashes no label text."""
    return F.struct(F.lit(code).alias("grain_code"), (F.lit(None) if start is None else start).cast("date").alias("sheet_start"),
                    (F.lit(None) if wom is None else wom).cast("int").alias("wom"))


def _categorised(fact: DataFrame, category: str | None, date_col: str) -> DataFrame:
    df = fact.where(contains_or_false(F.col("category_name"), category)) if category else fact
    return df.withColumn("_d", F.to_date(F.col(date_col)))


def _first_recent_month(df: DataFrame, weekly_months: int):
    """The earliest of the latest ``weekly_months`` months that ``df`` has,
    as a scalar subquery over its dates."""
    months = df.where(F.col("_d").isNotNull()).select(month_start("_d").alias("_m")).distinct()
    return months.orderBy(F.col("_m").desc()).limit(weekly_months).agg(F.min("_m")).scalar()


def _on_sheets(df: DataFrame, first_recent, weeks=None) -> DataFrame:
    """Each row once for every sheet it belongs to, as column ``_s``: month,
    quarter, week-of-month (recent months only; ``weeks`` lists other ones
    than its own) and All."""
    dated = F.col("_d").isNotNull()
    m = month_start("_d")
    recent = F.col("_recent")
    sheets = [F.when(dated, _sheet(1, m)), F.when(dated, _sheet(2, quarter_start("_d"))),
              *[F.when(recent, _sheet(3, m, w)) for w in (weeks or [_week_of_month_no(F.col("_d"))])], _sheet(4)]
    df = df.withColumn("_recent", dated & (m >= first_recent))
    return df.withColumn("_s", F.explode(F.array_compact(F.array(*sheets)))).drop("_recent")


def sheet_labels(df: DataFrame) -> DataFrame:
    """(grain_code, sheet_start, wom) -> grain and sheet name: ``Jan 2026``,
    ``Q1 2026``, ``Jan 2026 W1`` or ``All``."""
    code, start = F.col("grain_code"), F.col("sheet_start")
    grain = None
    for c, name in GRAIN_CODES.items():
        grain = F.when(code == c, name) if grain is None else grain.when(code == c, name)
    sheet = (F.when(code == 1, month_label(start))
              .when(code == 2, quarter_sheet(start))
              .when(code == 3, F.concat(month_label(start), F.lit(" W"), F.col("wom").cast("string")))
              .otherwise(F.lit("All")))
    rest = [c for c in df.columns if c not in ("grain_code", "sheet_start", "wom")]
    return df.select(grain.alias("grain"), sheet.alias("sheet"), *rest)


def _pillar_rows(df: DataFrame, pillars: list[PillarSpec]):
    """Adds grp, and ``_cell``: whether the row makes a cell of its pillar.
    A null site, name or state makes none."""
    df = df.withColumn("grp", _pillar_group(pillars))
    cell = (F.col("pillar_name").isin(*[p.name for p in pillars]) & non_empty("event_site_refid") & non_empty("grp")
            & F.col("event_site_name").isNotNull() & F.col("event_site_state").isNotNull() & _pillar_keep(pillars))
    return df.withColumn("_cell", F.coalesce(cell, F.lit(False)))


SITE = ["refid", "site_name", "state"]
SHEET = ["grain_code", "sheet_start", "wom"]


PILLAR, GRAIN, MONTH = 1_000_000_000, 10_000_000, 10  # places in a sheet's code
SPREAD = 16  # parts of a site's event and of its participant ids, for as many tasks


def _pillar_place(pillars: list[PillarSpec]):
    place = F.lit(None).cast("bigint")
    for i, p in reversed(list(enumerate(pillars))):
        place = F.when(F.col("pillar_name") == p.name, F.lit(i).cast("bigint")).otherwise(place)
    return place


def _codes_of(own):
    """The cells of an id's (month and recent week, group): (sheet, group)
    pairs, once more without the group for the total.  0 stands for no date."""
    when, month = own["when"], F.floor(own["when"] / MONTH).cast("bigint")
    sheets = [GRAIN + month * MONTH, 2 * GRAIN + (month - (month - 1) % 3) * MONTH, F.lit(4 * GRAIN), 3 * GRAIN + when]

    def pairs(of):
        return F.array(*[F.struct(c.cast("bigint").alias("sheet"), g.cast("string").alias("grp")) for g in (own["grp"], F.lit(None)) for c in of])
    return F.when(when == 0, pairs(sheets[2:3])).when(when % MONTH == 0, pairs(sheets[:3])).otherwise(pairs(sheets))


def _sheet_cells(df: DataFrame, pillars: list[PillarSpec], first_recent, sites: DataFrame | None = None) -> DataFrame:
    """Cells by (pillar and sheet as one number ``_code``, site, group), a
    null group for the true totals.  Each row of ``sites`` has besides a row
    of a null code.

    Two exchanges.  By site and a sixteenth of the ids, where one aggregate
    gathers the groups and months (in recent months, weeks) of an event or
    participant of a (pillar, site).  Nearly all have one: those are counted
    by month, an id of several counts once in each of the sheets and groups
    that they give.  The counts go by site, and fan out to the sheets there, so
    whatever groups by the site afterwards moves nothing.  A hot site's ids
    are spread over tasks, and its counts are few."""
    rows = _pillar_rows(df, pillars).where("_cell")
    recent = F.coalesce(month_start("_d") >= first_recent, F.lit(False))
    when = (F.year("_d") * 12 + F.month("_d")).cast("bigint") * MONTH + F.when(recent, _week_of_month_no(F.col("_d"))).otherwise(0)
    ids = F.array(F.struct(F.lit(1).alias("event"), F.col("event_id").cast("string").alias("id")),
                  F.struct(F.lit(0).alias("event"), F.col("participant_id").cast("string").alias("id")))
    # A pillar and month are one number, and what differs from row to row stands together, so the rows pack well.
    rows = rows.select((_pillar_place(pillars) * PILLAR + F.coalesce(when, F.lit(0))).alias("at"), F.col("event_site_refid").alias("refid"),
                       F.col("event_site_name").alias("site_name"), F.col("event_site_state").alias("state"), "grp", F.explode(ids).alias("_i"))
    part = F.pmod(F.xxhash64("_i.id"), F.lit(SPREAD)) * 2 + F.col("_i.event")
    rows = rows.where("_i.id is not null").select(part.cast("int").alias("part"), "at", *SITE, "_i.id", "grp").repartition("part", *SITE)
    gathered = rows.groupBy(*SITE, "part", F.floor(F.col("at") / PILLAR).alias("place"), "id").agg(
        F.collect_set(F.struct("grp", (F.col("at") % PILLAR).alias("when"))).alias("own"))
    one = F.array(F.struct(F.col("own")[0]["grp"].alias("grp"), F.col("own")[0]["when"].alias("when"), F.lit(None).cast("bigint").alias("sheet")))
    many = F.transform(F.array_distinct(F.flatten(F.transform("own", _codes_of))), lambda c: F.struct(
        c["grp"].alias("grp"), F.lit(None).cast("bigint").alias("when"), c["sheet"].alias("sheet")))
    cells = gathered.select(*SITE, "part", "place", F.explode(F.when(F.size("own") == 1, one).otherwise(many)).alias("_c"))
    n, event = F.count(F.lit(1)), F.col("part") % 2 == 1
    cells = cells.groupBy(*SITE, "part", "place", "_c.grp", "_c.when", "_c.sheet").agg(
        F.when(event, n).otherwise(0).alias("events"), F.when(event, 0).otherwise(n).alias("pax")).drop("part")
    if sites is not None:
        cells = cells.unionByName(sites.select(*SITE), allowMissingColumns=True)
    cells = cells.repartition(first_partitions(df.sparkSession), *SITE)
    own = F.struct("sheet", "grp")
    spread = F.when(F.col("when").isNotNull(), _codes_of({"when": F.col("when"), "grp": F.col("grp")})).otherwise(F.array(own))
    cells = cells.select("place", *SITE, "events", "pax", F.explode(spread).alias("_c"))
    return cells.groupBy(*SITE, (F.col("place") * PILLAR + F.col("_c.sheet")).alias("_code"), F.col("_c.grp").alias("grp")).agg(
        F.sum("events").alias("events"), F.sum("pax").alias("pax"))


def pivot_all_grains(fact: DataFrame, pillars: list[PillarSpec], category: str | None = "NADI4U",
                     date_col: str = "event_start", weekly_months: int = WEEKLY_SHEET_MONTHS) -> DataFrame:
    """Long form of every (pillar, sheet) pivot: one row per non-empty cell,
    group 'Total' carrying the true per-site distinct totals."""
    df = _categorised(fact, category, date_col)
    cells = _sheet_cells(df, pillars, _first_recent_month(df, weekly_months))
    code = F.col("_code")
    name = F.element_at(F.array(*[F.lit(p.name) for p in pillars]), (F.floor(code / PILLAR) + 1).cast("int"))
    month = F.floor(code % GRAIN / MONTH).cast("int") - 1
    start = F.when(month >= 0, F.make_date(F.floor(month / 12).cast("int"), month % 12 + 1, F.lit(1)))
    keyed = cells.select(name.alias("pillar_name"), F.floor(code % PILLAR / GRAIN).cast("int").alias("grain_code"), start.alias("sheet_start"),
                         (code % MONTH).cast("int").alias("wom"), *SITE, F.coalesce("grp", F.lit("Total")).alias("grp"), "events", "pax")
    return sheet_labels(keyed).select("pillar_name", "grain", "sheet", *SITE, "grp", "events", "pax")


def _sheet_code(grain, start, wom):
    """A compact sheet key as one number."""
    month = F.coalesce(F.year(start) * 12 + F.month(start), F.lit(0))
    return grain.cast("bigint") * GRAIN + month * MONTH + F.coalesce(wom, F.lit(0))


def _sheet_list(months, weekly_months: int):
    """The sheets of the (sorted) months: each month and its quarters, W1 to
    W4 of the latest ``weekly_months``, and All."""
    recent = F.slice(months, F.greatest(F.size(months) - weekly_months + 1, F.lit(1)), F.lit(weekly_months))
    quarters = F.array_distinct(F.transform(months, lambda m: F.date_trunc("quarter", m).cast("date")))
    weeks = F.transform(recent, lambda m: F.array(*[_sheet(3, m, F.lit(w)) for w in (1, 2, 3, 4)]))
    return F.concat(F.transform(months, lambda m: _sheet(1, m)), F.transform(quarters, lambda q: _sheet(2, q)), F.flatten(weeks),
                    F.array(_sheet(4)))


def complete_sheets(fact: DataFrame, pillars: list[PillarSpec], category: str | None = "NADI4U", date_col: str = "event_start",
                    weekly_months: int = WEEKLY_SHEET_MONTHS) -> DataFrame:
    """Every sheet of every pillar with every site of the fact and every group
    of the pillar, zeros included: the sheets as they are published.

    Cells are sparse until the last step.  Three small lists make the rest:
    the sheets (from the months of the category's rows, so a month without a
    pillar's events is there too), the pillars with their groups (fixed, or
    those that the pillar's rows have) and the sites.  A site's cells are
    gathered by sheet, bounded by sheets x groups, and its zeros are made
    where its row is, so the dense rows are never joined or shuffled."""
    named = F.coalesce(contains_or_false(F.col("category_name"), category), F.lit(False)) if category else F.lit(True)
    df = fact.withColumn("_d", F.to_date(F.col(date_col)))
    # Fixed groups are not looked up, so neither are the columns that they are made of.
    free = [p.name for p in pillars if not p.groups]
    of = _pillar_group([p for p in pillars if p.name in free])
    grouped = df.where(named).withColumn("grp", F.lit(None).cast("string") if of is None else of)
    loose = F.col("pillar_name").isin(*free) & non_empty("grp")
    found = grouped.agg(F.sort_array(F.collect_set(month_start("_d"))).alias("months"),
                        F.sort_array(F.collect_set(F.when(loose, F.struct("pillar_name", "grp")))).alias("groups"))
    months, groups = F.col("months"), F.col("groups")
    spec = F.array(*[F.struct(
        F.lit(i).cast("bigint").alias("place"), F.lit(p.name).alias("pillar_name"),
        (F.array(*map(F.lit, p.groups)).cast("array<string>") if p.groups else _groups_of(groups, p.name)).alias("grps"),
        _sheet_list(months, weekly_months).alias("sheets")) for i, p in enumerate(pillars)])
    lists = found.select(F.struct(spec.alias("pillars"), F.when(
        F.size(months) > 0, F.element_at(months, -F.least(F.size(months), F.lit(weekly_months)))).alias("first_recent"))).scalar()
    first_recent = lists["first_recent"]
    sites = df.where(non_empty("event_site_refid")).select(*[F.col(f"event_site_{c}").alias(n) for c, n in zip(("refid", "name", "state"), SITE, strict=True)])
    cells = _sheet_cells(df.where(named), pillars, first_recent, sites.distinct())
    by_sheet = cells.groupBy(*SITE, F.col("_code").alias("_key")).agg(F.map_from_entries(F.collect_list(
        F.struct(F.coalesce("grp", F.lit("")).alias("grp"), F.struct("events", "pax")))).alias("_cells"))
    by_site = by_sheet.groupBy(*SITE).agg(F.map_from_entries(F.collect_list(
        F.when(F.col("_key").isNotNull(), F.struct("_key", "_cells")))).alias("_own"))
    grid = by_site.select(*SITE, "_own", F.explode(lists["pillars"]).alias("_p"))
    low = F.col("_p.place") * PILLAR  # a row per sheet carries its pillar's cells only
    grid = grid.select(*SITE, "_p.*", F.map_filter("_own", lambda k, _: (k >= low) & (k < low + PILLAR)).alias("_own"))
    grid = grid.select(*SITE, "_own", "place", "pillar_name", "grps", F.explode("sheets").alias("_s"))
    code = F.col("place") * PILLAR + _sheet_code(F.col("_s.grain_code"), F.col("_s.sheet_start"), F.col("_s.wom"))
    grid = grid.select(*SITE, "pillar_name", "grps", "_s", F.try_element_at("_own", code).alias("_cells"))
    grid = grid.select("pillar_name", "_s.*", *SITE, "_cells", F.explode(F.concat("grps", F.array(F.lit("")))).alias("grp"))
    cell = F.try_element_at("_cells", F.col("grp"))
    out = grid.select("pillar_name", *SHEET, *SITE, F.when(F.col("grp") == "", "Total").otherwise(F.col("grp")).alias("grp"),
                      F.coalesce(cell["events"], F.lit(0)).cast("bigint").alias("events"), F.coalesce(cell["pax"], F.lit(0)).cast("bigint").alias("pax"))
    return sheet_labels(out).select("pillar_name", "grain", "sheet", *SITE, "grp", "events", "pax")


def _groups_of(groups, pillar: str):
    return F.transform(F.filter(groups, lambda g: g["pillar_name"] == pillar), lambda g: g["grp"])


def active_sites_per_sheet(fact: DataFrame, pillars: list[PillarSpec], category: str | None = "NADI4U",
                           date_col: str = "event_start", weekly_months: int = WEEKLY_SHEET_MONTHS) -> DataFrame:
    """Sites with any non-zero cell, per pillar and sheet.  Every pillar is
    on every sheet: the months and quarters of all rows, W1 to W4 of the
    recent months whether or not they have events, and All."""
    df = _pillar_rows(_categorised(fact, category, date_col), pillars)
    day = df.select(F.when(F.col("_cell"), F.col("pillar_name")).alias("pillar_name"),
                    F.when(F.col("_cell"), F.col("event_site_refid")).alias("refid"), "_d").distinct()
    first = _first_recent_month(_categorised(fact, category, date_col), weekly_months)
    weeks = [F.lit(w) for w in (1, 2, 3, 4)]
    tagged = _on_sheets(day, first, weeks).select("pillar_name", "refid", "_d", "_s.*")
    own_week = F.col("wom").isNull() | (F.col("wom") == _week_of_month_no(F.col("_d")))
    none = fact.sparkSession.createDataFrame([(4,)], "grain_code int")  # the sheet All of an empty fact
    tagged = tagged.unionByName(none, allowMissingColumns=True)
    counts = [F.count_distinct(F.when((F.col("pillar_name") == p.name) & own_week, F.col("refid"))).cast("bigint").alias(f"p{i}")
              for i, p in enumerate(pillars)]
    per = tagged.groupBy("grain_code", "sheet_start", "wom").agg(*counts)
    pairs = F.explode(F.array(*[F.struct(F.lit(p.name).alias("pillar_name"), F.col(f"p{i}").alias("active_sites"))
                                for i, p in enumerate(pillars)]))
    return sheet_labels(per.withColumn("_p", pairs)).select("_p.pillar_name", "grain", "sheet", "_p.active_sites")


# ---------------------------------------------------------------------------
# State x month-of-year report
# ---------------------------------------------------------------------------

def _state_month_cells(fact: DataFrame, sites: DataFrame, site_col: str, date_col: str) -> DataFrame:
    """Stage 1: per site x month-of-year distinct events (participant rows,
    non-empty site), summed per state: a sum over sites, not a distinct
    count per state."""
    per_site = (fact.where(F.col("participant_id").isNotNull() & non_empty(site_col) & F.col(date_col).isNotNull())
                    .groupBy(F.col(site_col).alias("refid"), F.month(date_col).alias("month"))
                    .agg(F.count_distinct("event_id").cast("bigint").alias("events")))
    dim = site_dimension(sites).select("refid", F.upper(F.trim(F.col("state"))).alias("state"))
    return (per_site.join(dim, "refid", "inner")
                    .groupBy("state", "month").agg(F.sum("events").cast("bigint").alias("events")))


def _state_grid(sites: DataFrame, states: list[str] | None) -> DataFrame:
    spark = sites.sparkSession
    if states:
        st = spark.createDataFrame([(s,) for s in states], "state string")
    else:
        st = site_dimension(sites).select(F.upper(F.trim(F.col("state"))).alias("state")).distinct()
    return st.select("state", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))


def state_month_matrix(fact: DataFrame, sites: DataFrame, states: list[str] | None = REPORT_STATES,
                       site_col: str = "event_site_refid", date_col: str = "event_startdate") -> DataFrame:
    """(state, month 1-12, events) for the listed states; zero shows as null.
    Different years fall into the same month column."""
    cells = _state_month_cells(fact, sites, site_col, date_col)
    grid = _state_grid(sites, states)
    out = grid.join(cells, ["state", "month"], "left")
    return out.select("state", "month", F.when(F.col("events") > 0, F.col("events")).alias("events"))


def state_report(fact: DataFrame, sites: DataFrame, states: list[str] = REPORT_STATES,
                 site_col: str = "event_site_refid", date_col: str = "event_startdate") -> DataFrame:
    """The report's form of the matrix: the states in the given order, then
    TOTAL, with a column for each month and ``total``; zero shows as null."""
    cells = _state_month_cells(fact, sites, site_col, date_col)
    spark = sites.sparkSession
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(states)], "place int, state string")
    listed = rows.join(cells, "state", "left").select("month", "events", F.explode(F.array(
        F.struct("place", "state"), F.struct(F.lit(len(states)).alias("place"), F.lit("TOTAL").alias("state")))).alias("r"))
    months = [F.sum(F.when(F.col("month") == m, F.col("events"))).cast("bigint").alias(f"m{m}") for m in range(1, 13)]
    out = listed.groupBy("r.place", "r.state").agg(*months, F.sum("events").cast("bigint").alias("total"))
    shown = [F.when(F.col(c) > 0, F.col(c)).alias(c) for c in [*(f"m{m}" for m in range(1, 13)), "total"]]
    return out.orderBy("place").select("state", *shown)


def state_month_totals(fact: DataFrame, sites: DataFrame, states: list[str] | None = REPORT_STATES,
                       site_col: str = "event_site_refid", date_col: str = "event_startdate") -> DataFrame:
    """Row totals per state, column totals per month and the grand total of
    the matrix (CUBE over the stage-1 table); zero shows as null."""
    cells = _state_month_cells(fact, sites, site_col, date_col)
    grid = _state_grid(sites, states).join(cells, ["state", "month"], "left")
    cube = (grid.cube("state", "month").agg(F.sum(F.coalesce("events", F.lit(0))).cast("bigint").alias("events"),
                                             F.grouping("state").alias("gs"), F.grouping("month").alias("gm"))
                .where((F.col("gs") == 1) | (F.col("gm") == 1)))
    return cube.select(F.when(F.col("gs") == 1, F.lit("TOTAL")).otherwise(F.col("state")).alias("state"),
                       F.when(F.col("gm") == 1, F.lit(0)).otherwise(F.col("month")).alias("month"),
                       F.when(F.col("events") > 0, F.col("events")).alias("events"))
