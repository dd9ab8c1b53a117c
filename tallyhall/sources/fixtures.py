"""Adapter from the driver's relational test tables to the logical model.

Mapping (see FIXTURES.md): an order is an event, a line item is a
participant row, a supplier is a site, nation/region are state/region and
the tp -> dusp organisation hierarchy.  ``Tables`` gives the test tables the
logical names and columns, ``GRAPH`` is the library's lookup graph with the
few places where these tables hold a fact elsewhere: a person's attributes
stand in the participant row, the program, creator and home site come with
the event's customer, the title with the participant's part.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SUBCATEGORIES
from ..functions.text import site_name_fallback
from ..operators import fact as builder
from ..operators.lookups import Field, Link, same, text
from .readers import read_table

# Status excluded in the fixture ('P' stands in for the cancelled ids).
FIXTURE_EXCLUDED = ("P",)
# Women class and truthiness are expressed in the domain's own values.
FIXTURE_WOMEN_FLAG = "A"

FACT_COLUMNS = [
    "event_id", "participant_id", "member_id", "under12_id", "participant_type",
    "participant_name", "identity_no", "gender", "age", "oku_status", "attendance",
    "program_name", "event_site_id", "event_site_refid", "event_site_name", "event_site_state",
    "event_site_region", "event_site_tp", "event_site_dusp", "event_site_phase",
    "status_id", "subcategory_id", "category_name", "pillar_name", "event_start",
    "event_startdate", "event_end", "requester_id", "program", "sub_pillar_name",
    "creator_type", "deeper_sub_pillar", "home_refid", "home_site_name", "home_state",
]

def subcategory_dim(spark: SparkSession) -> DataFrame:
    """The 13-row subcategory dimension (fixed size: safe to broadcast)."""
    return spark.createDataFrame(SUBCATEGORIES, "subcategory_id int, category_name string, "
                                                "module string, sub_label string")


def organizations(spark: SparkSession, root: str) -> DataFrame:
    """Typed organisation table: nations are 'tp' orgs whose parent is their
    region, an org of type 'dusp'."""
    nation = read_table(spark, root, "nation")
    region = read_table(spark, root, "region")
    tp = nation.select(F.col("n_nationkey").cast("bigint").alias("org_id"),
                       F.concat(F.lit("TP "), F.col("n_name")).alias("org_name"),
                       F.lit("tp").alias("org_type"),
                       (F.col("n_regionkey") + 1000).cast("bigint").alias("parent_id"))
    dusp = region.select((F.col("r_regionkey") + 1000).cast("bigint").alias("org_id"),
                         F.concat(F.lit("DUSP "), F.col("r_name")).alias("org_name"),
                         F.lit("dusp").alias("org_type"),
                         F.lit(None).cast("bigint").alias("parent_id"))
    return tp.unionByName(dusp)


def _categories() -> list[str]:
    return list(dict.fromkeys(cat for _, cat, _, _ in SUBCATEGORIES))


def _subcategory() -> Column:
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    return digit + F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "F", 5).otherwise(8)


def _category_id(subcategory: Column) -> Column:
    out = F.lit(None).cast("int")
    for i, cat in enumerate(_categories()):
        out = F.when(subcategory.isin(*[n for n, c, _, _ in SUBCATEGORIES if c == cat]), F.lit(i)).otherwise(out)
    return out


def _refid(key: str | Column) -> Column:
    return F.concat(F.lit("S"), (F.col(key) if isinstance(key, str) else key).cast("string"))


def _participant(order: str | Column, line: str | Column) -> Column:
    order, line = (F.col(c) if isinstance(c, str) else c for c in (order, line))
    return F.concat(order.cast("string"), F.lit("-"), line.cast("string"))


class Tables(Mapping[str, DataFrame]):
    """The test tables by logical name, each made when it is asked for."""

    def __init__(self, spark: SparkSession, root: str, excluded: tuple = ()):
        self.spark, self.root, self.excluded = spark, root, excluded
        self._made: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    def events(self) -> DataFrame:
        o = self._read("orders")
        if self.excluded:
            o = o.where(~F.col("o_orderstatus").isin(*self.excluded))
        return o.select(
            F.col("o_orderkey").alias("event_id"), _category_id(_subcategory()).alias("category_id"), _subcategory().alias("subcategory_id"),
            F.col("o_custkey").alias("program_id"), F.col("o_custkey").alias("requester_id"), F.col("o_orderdate").alias("event_start"),
            F.col("o_orderdate").alias("event_end"), F.col("o_custkey").alias("created_by"), F.col("o_orderstatus").alias("status_id"),
            F.col("o_orderpriority").alias("priority"))

    def categories(self) -> DataFrame:
        return self.spark.createDataFrame(list(enumerate(_categories())), "id int, name string")

    def subcategories(self) -> DataFrame:
        return self.spark.createDataFrame([(i, module, _categories().index(cat)) for i, cat, module, _ in SUBCATEGORIES],
                                          "id int, name string, category_id int")

    def participants(self) -> DataFrame:
        member, under12 = F.col("l_linenumber") <= 5, F.col("l_linenumber") == 6
        return self._read("lineitem").select(
            _participant("l_orderkey", "l_linenumber").alias("participant_id"), F.col("l_orderkey").alias("event_id"),
            F.col("l_linenumber").alias("line_no"), (F.col("l_linestatus") == "F").alias("attendance"),
            F.when(member, F.col("l_partkey")).alias("member_id"), F.when(under12, F.col("l_partkey")).alias("under12_id"),
            F.col("l_suppkey").alias("site_id"), F.col("l_partkey").alias("part_id"), _refid("l_suppkey").alias("refid"),
            F.when(member | under12, F.concat(F.lit("Person#"), F.col("l_partkey").cast("string"))).alias("person"),
            F.when(member, F.col("l_partkey").cast("string")).alias("identity_no"),
            F.when(F.col("l_returnflag") == FIXTURE_WOMEN_FLAG, "Perempuan").otherwise("Lelaki").alias("gender"),
            F.col("l_quantity").alias("age"), F.when(F.col("l_discount") == 0, "true").otherwise("false").alias("oku_status"))

    def requesters(self) -> DataFrame:
        # Home sites: customers are spread over the sites by key modulo the
        # number of sites (a scalar subquery, evaluated once).
        n_sites = self._read("supplier").select(F.count(F.lit(1)))
        return self._read("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation_id"),
            F.when(F.col("c_acctbal") >= 0, "sso_admin").otherwise("member").alias("user_type"),
            (F.col("c_custkey") % n_sites.scalar()).alias("home_site_id"))

    def parts(self) -> DataFrame:
        return self._read("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))

    def site_profiles(self) -> DataFrame:
        balance = F.col("s_acctbal")
        return self._read("supplier").select(
            F.col("s_suppkey").alias("site_id"), _refid("s_suppkey").alias("refid"),
            site_name_fallback(F.col("s_name"), F.col("s_suppkey")).alias("site_name"), F.col("s_nationkey").cast("bigint").alias("org_id"),
            F.col("s_nationkey").alias("state_id"),
            F.when(balance < 0, "Phase 1").when(balance < 5000, "Phase 2").otherwise("Phase 3").alias("phase"))

    def organizations(self) -> DataFrame:
        return organizations(self.spark, self.root)

    def states(self) -> DataFrame:
        return self._read("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region_id"))

    def regions(self) -> DataFrame:
        return self._read("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name not in self:
                raise KeyError(name)
            self._made[name] = getattr(self, name)()
        return self._made[name]

    def __iter__(self):
        return iter(("events", "categories", "subcategories", "participants", "requesters", "parts", "site_profiles", "organizations",
                     "states", "regions"))

    def __len__(self) -> int:
        return len(list(iter(self)))

    def __contains__(self, name) -> bool:
        return name in list(iter(self))


def _site_json(custkey, segment):
    k = custkey.cast("string")
    return (F.when(segment == "AUTOMOBILE", F.concat(F.lit("["), k, F.lit("]")))
            .when(segment == "BUILDING", F.lit("[]"))
            .when(segment == "FURNITURE", F.concat(F.lit('{"site": '), k, F.lit("}")))
            .when(segment == "HOUSEHOLD", k)
            .otherwise(F.lit("not json")))


_PLACES = {"region": Link("regions", "state.region_id")}
_PLACE_FIELDS = {"region": same("region.name"), "phase": same("phase")}
GRAPH = (
    builder.GRAPH
    .extended("profile", _PLACE_FIELDS, _PLACES)
    .extended("site", _PLACE_FIELDS, _PLACES)
    .extended("requesters", {"nation": same("nation.name"), "home_refid": Field(("home_site_id",), lambda k: F.concat(F.lit("S"), k.cast("string"))),
                             "home_site_name": same("home.site_name"), "home_state": text("home.state")},
              {"nation": Link("states", "nation_id"), "home": Link("profile", "home_site_id", "site_id")})
    .extended("event", {"pillar_name": same("priority"), "sub_pillar_name": same("requester.segment"), "program": same("requester.segment"),
                        "creator_type": same("requester.user_type"),
                        "site_json": Field(("requester_id", "requester.segment"), _site_json),
                        "deeper_sub_pillar": Field(("requester.user_type", "requester.nation"), builder.officer_type_of),
                        **{c: same(f"requester.{c}") for c in ("home_refid", "home_site_name", "home_state")}},
              {"requester": Link("requesters", "requester_id")})
    .extended("fact", {"participant_name": same("person"), "gender": same("gender"), "gender_name": same("gender"),
                       **{c: same(c) for c in ("identity_no", "age", "oku_status")},
                       # The texts of these keys are made behind the joins, so the numbers cross their exchanges.
                       "participant_id": Field(("event_id", "line_no"), _participant), "event_site_refid": Field(("site_id",), _refid),
                       "program_name": same("part.name"), "event_site_region": text("site.region"),
                       **{c: same(f"event.{c}") for c in ("program", "creator_type", "home_refid", "home_site_name", "home_state")}},
              {"part": Link("parts", "part_id")}))
# These tables have no address and officer lookups, so none can repeat rows.
UNIQUE = builder.UNIQUE | {"addresses.site_id", "officers.user_id", "requesters.id", "parts.id", "regions.id"}


def events(spark: SparkSession, root: str) -> DataFrame:
    """Logical event table (all statuses), one row per event."""
    columns = ["event_id", "site_json", "subcategory_id", "program_id", "program", "status_id", "event_start", "event_end", "pillar_name"]
    return GRAPH.plan(Tables(spark, root), "event", columns, UNIQUE)


def sites(spark: SparkSession, root: str) -> DataFrame:
    """Site dimension: one row per site profile with its geography."""
    columns = ["site_id", "refid", "site_name", "state", "region", "tp", "dusp", "phase"]
    s = GRAPH.plan(Tables(spark, root), "profile", columns, UNIQUE)
    return s.fillna("", subset=["state", "region", "tp", "dusp"])


def addresses(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(addresses, districts): customers stand for the sites' addresses,
    several to a site, and nations for districts."""
    n_sites = read_table(spark, root, "supplier").select(F.count(F.lit(1)))
    a = read_table(spark, root, "customer").select(
        (F.col("c_custkey") % n_sites.scalar()).alias("site_id"), F.col("c_name").alias("address1"),
        F.col("c_mktsegment").alias("address2"), F.col("c_custkey").cast("string").alias("postcode"),
        F.col("c_nationkey").alias("district_id"))
    d = read_table(spark, root, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return a, d


def event_log(spark: SparkSession, root: str) -> DataFrame:
    """Intra-day activity log with JSON attributes (durations, JSON tests)."""
    return read_table(spark, root, "events")


def fact(spark: SparkSession, root: str, columns: list[str] | None = None, excluded: tuple = FIXTURE_EXCLUDED,
         personal: bool = False) -> DataFrame:
    """Consolidated participant-level fact (event x participant rows), by the
    library's builder: inner join event x participant, then the lookups that
    the requested ``columns`` need.  Excluded statuses are filtered at the
    orders scan (pushed down); identity numbers are masked unless
    ``personal``."""
    want = set(columns or FACT_COLUMNS)
    unknown = want - set(FACT_COLUMNS)
    if unknown:
        raise ValueError(f"unknown fact columns: {sorted(unknown)}")
    return builder.build_fact(Tables(spark, root, excluded), [c for c in FACT_COLUMNS if c in want], personal=personal, graph=GRAPH, unique=UNIQUE)


def event_taxonomy(spark: SparkSession, root: str, columns: list[str]) -> DataFrame:
    """The taxonomy extract of all events, by their own keys."""
    return builder.event_taxonomy(Tables(spark, root), "event", columns, GRAPH, UNIQUE)


def event_parts(spark: SparkSession, root: str, excluded: tuple = FIXTURE_EXCLUDED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(participants, events, titles) below the fact, for eager aggregation."""
    t = Tables(spark, root, excluded)
    participants = t["participants"].select("event_id", "refid", "participant_id", "attendance", "part_id")
    return participants, GRAPH.plan(t, "event", ["event_id", "program", "event_startdate"], UNIQUE), t["parts"]
