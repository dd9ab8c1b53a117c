"""The participant-level fact, built over the logical tables.

A source is a dict of DataFrames by table name, with the columns named in
``TABLES``; how they come from a database or a file is a reader's business.
Dimensions play two roles (the event's site and the member's home site;
a member's and a child's gender), each with its own prefix.  Lookups are
left joins, so a row survives a missing dimension; an address or officer
lookup that has several rows for a key keeps all of them, and the counts
downstream are distinct counts.

``GRAPH`` says which lookup gives which column, and only those that the asked
columns need are joined (:mod:`.lookups`).  Personal data is masked or left
out unless it is asked for with ``personal=True``.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import address_line, mask_identity, site_name_fallback
from .joins import dedupe_first
from .lookups import Entity, Field, Graph, Link, first_of, same, text

Source = Mapping[str, DataFrame]

# The logical tables and their columns.
TABLES: dict[str, str] = {
    "events": "event_id bigint, category_id int, subcategory_id int, program_id bigint, program_name string, method_id int, "
              "description string, requester_id bigint, event_start timestamp, event_end timestamp, created_at timestamp, "
              "created_by bigint, status_id string, site_json string",
    "categories": "id int, name string", "subcategories": "id int, name string, category_id int",
    "programs": "id bigint, name string, subcategory_id int", "methods": "id int, name string",
    "profiles": "id bigint, full_name string, user_type string", "officers": "user_id bigint, master_id int",
    "master": "id int, name string",
    "participants": "participant_id string, event_id bigint, attendance boolean, verified boolean, new_member boolean, "
                    "member_id bigint, under12_id bigint, site_id bigint",
    "members": "id bigint, full_name string, identity_no string, mobile_no string, email string, dob date, age string, "
               "join_date date, gender_id int, race_id int, oku_status string, education_level string, income_range string, "
               "nationality_id string, membership string, registration string, home_site_id bigint",
    "under12": "id bigint, full_name string, mobile_no string, gender_id int",
    "genders": "id int, name string", "races": "id int, name string",
    "site_profiles": "site_id bigint, refid string, refid_tp string, site_name string, full_name string, org_id bigint, "
                     "state_id int, parliament_id int, dun_id int, phase_id int, zone_id int, technology_id int, "
                     "bandwidth_id int, latitude double, longitude double, is_mini boolean, remark string",
    "organizations": "org_id bigint, org_name string, org_type string, parent_id bigint",
    "states": "id int, name string", "parliaments": "id int, name string", "duns": "id int, name string",
    "phases": "id int, name string", "zones": "id int, name string", "technologies": "id int, name string",
    "bandwidths": "id int, name string",
    "addresses": "site_id bigint, address1 string, address2 string, postcode string, district_id int",
    "districts": "id int, name string",
    "home_sites": "id bigint, refid string, standard_code string, site_id bigint",
}


# Keys that a table has once at most.  A site may have several addresses and
# a user several officer roles, so those lookups always count.
UNIQUE = frozenset([
    "events.event_id", "site_profiles.site_id", "organizations.org_id",
    *(f"{t}.id" for t in ("categories", "subcategories", "programs", "methods", "profiles", "master", "members", "under12", "genders",
                          "races", "states", "parliaments", "duns", "phases", "zones", "technologies", "bandwidths", "districts",
                          "home_sites"))])

PROFILE_LINKS = {
    "tp": Link("organizations", "org_id", "org_id", only=lambda: F.col("org_type") == "tp"),
    "dusp": Link("organizations", "tp.parent_id", "org_id", only=lambda: F.col("org_type") == "dusp"),
    "state": Link("states", "state_id"), "parliament": Link("parliaments", "parliament_id"), "dun": Link("duns", "dun_id"),
    "phase": Link("phases", "phase_id"), "zone": Link("zones", "zone_id"), "technology": Link("technologies", "technology_id"),
    "bandwidth": Link("bandwidths", "bandwidth_id")}
PROFILE_FIELDS = {
    "fullname": same("full_name"), "tp": same("tp.org_name"), "dusp": same("dusp.org_name"),
    **{c: same(f"{c}.name") for c in ("state", "parliament", "dun", "phase", "zone", "technology")},
    "backhaul": same("bandwidth.name"), "mini": same("is_mini"), "operation_status": same("remark")}
ADDRESS_COLUMNS = ("district", "address", "postcode")
SITE_COLUMNS = ["site_id", "refid", "refid_tp", "site_name", "fullname", "dusp", "tp", "state", "parliament", "dun", *ADDRESS_COLUMNS,
                "phase", "zone", "technology", "backhaul", "latitude", "longitude", "mini", "operation_status"]
SITE_OTHER = ("site_id", "latitude", "longitude", "mini")  # the rest are texts
HOME_COLUMNS = ["refid", "standard_code", "site_name", "state", "tp", "phase", "parliament", "dun"]


def site_role(column: str) -> str:
    """A site column's name in the role of the event's site."""
    return "event_site_name" if column == "site_name" else f"event_site_{column}"


EVENT_COLUMNS = ["category_name", "pillar_name", "sub_pillar_name", "deeper_sub_pillar", "program_name", "program_method", "event_start",
                 "event_startdate", "event_end", "event_created_at", "event_created_by_name", "event_created_by_type", "subcategory_id",
                 "requester_id"]
CONTACT_COLUMNS = ("mobile_no", "email", "dob", "under12_phone")
PARTICIPANT_COLUMNS = ["participant_id", "event_id", "attendance", "verified", "new_member", "member_id", "under12_id", "participant_type",
                       "participant_name", "identity_no", "mobile_no", "email", "dob", "age", "join_date", "gender", "gender_name", "race",
                       "oku_status", "education_level", "income_range", "nationality_id", "membership", "registration", "under12_name",
                       "under12_phone", "under12_gender", *(f"home_{c}" for c in HOME_COLUMNS), "event_site_id"]
FACT_COLUMNS = [*PARTICIPANT_COLUMNS[:2], *EVENT_COLUMNS, *PARTICIPANT_COLUMNS[2:],
                *(site_role(c) for c in SITE_COLUMNS if c != "site_id")]


def participant_type(member: str | Column = "member_id", under12: str | Column = "under12_id") -> Column:
    member, under12 = (F.col(c) if isinstance(c, str) else c for c in (member, under12))
    return F.when(member.isNotNull(), "Member").when(under12.isNotNull(), "Under 12").otherwise("Unknown")


def officer_type_of(creator_type: Column, officer_type: Column) -> Column:
    """The officer's type shows only for creators of type ``sso_admin``."""
    return F.when(creator_type == "sso_admin", officer_type)


EVENT_FIELDS = {
    "category_name": text("category.name"), "pillar_name": text("subcategory.name"), "sub_pillar_name": text("program.name"),
    "deeper_sub_pillar": Field(("creator.user_type", "officer.officer_type"), officer_type_of),
    "program_name": first_of("program_name", "program.name", default=""), "program_method": text("method.name"),
    "event_startdate": Field(("event_start",), F.to_date), "event_lastdate": Field(("event_end",), F.to_date),
    "event_created_at": same("created_at"), "event_created_by_name": text("creator.full_name"),
    "event_created_by_type": text("creator.user_type"),
    # The taxonomy extract: by the event's own keys, or by way of the program.
    "event_category": text("category.name"), "program_module": text("subcategory.name"), "program": text("program.name"),
    "by_program_module": text("by_program.name"), "by_program_category": text("by_program.category"),
    "event_description": text("description")}
EVENT_LINKS = {
    "category": Link("categories", "category_id"), "subcategory": Link("subcategories", "subcategory_id"),
    "program": Link("programs", "program_id"), "method": Link("methods", "method_id"), "creator": Link("profiles", "created_by"),
    "officer": Link("officer", "created_by", "user_id"), "by_program": Link("module", "program.subcategory_id")}

PARTICIPANT_FIELDS = {
    "participant_type": Field(("member_id", "under12_id"), participant_type),
    "participant_name": first_of("member.full_name", "child.full_name"),
    "identity_no": same("member.identity_no"), "mobile_no": text("member.mobile_no"), "email": text("member.email"),
    **{c: same(f"member.{c}") for c in ("dob", "age", "join_date")},
    "gender": text("member.gender"), "gender_name": text("shown_gender.name"), "race": text("member.race"),
    "oku_status": first_of("member.oku_status", default="false"),
    **{c: text(f"member.{c}") for c in ("education_level", "income_range", "nationality_id", "membership", "registration")},
    "under12_name": text("child.full_name"), "under12_phone": text("child.mobile_no"), "under12_gender": text("child.gender"),
    **{f"home_{c}": text(f"member.home_{c}") for c in HOME_COLUMNS}, "event_site_id": same("site_id")}
PARTICIPANT_LINKS = {
    "member": Link("member", "member_id"), "child": Link("child", "under12_id"),
    # The gender that a report shows is the member's, else the child's: a computed key.
    "shown_gender": Link("genders", Field(("member.gender_id", "child.gender_id"), F.coalesce))}

GRAPH = Graph({
    "profile": Entity("site_profiles", PROFILE_FIELDS, PROFILE_LINKS),
    "address": Entity("addresses", {"district": same("area.name"), "address": Field(("address1", "address2"), address_line)},
                      {"area": Link("districts", "district_id")}),
    "site": Entity("site_profiles", {**PROFILE_FIELDS, **{c: same(f"address.{c}") for c in ADDRESS_COLUMNS}},
                   {**PROFILE_LINKS, "address": Link("address", "site_id", "site_id")}),
    "home": Entity("home_sites", {"refid": text("refid"), "standard_code": text("standard_code"),
                                  "site_name": Field(("profile.site_name", "id"), site_name_fallback),
                                  **{c: text(f"profile.{c}") for c in ("state", "tp", "phase", "parliament", "dun")}},
                   {"profile": Link("profile", "site_id", "site_id")}),
    "module": Entity("subcategories", {"category": same("category.name")}, {"category": Link("categories", "category_id")}),
    "officer": Entity("officers", {"officer_type": same("kind.name")}, {"kind": Link("master", "master_id")}),
    "event": Entity("events", EVENT_FIELDS, EVENT_LINKS),
    "member": Entity("members", {"gender": same("gender.name"), "race": same("race.name"), **{f"home_{c}": same(f"home.{c}") for c in HOME_COLUMNS}},
                     {"gender": Link("genders", "gender_id"), "race": Link("races", "race_id"), "home": Link("home", "home_site_id")}),
    "child": Entity("under12", {"gender": same("gender.name")}, {"gender": Link("genders", "gender_id")}),
    "participant": Entity("participants", PARTICIPANT_FIELDS, PARTICIPANT_LINKS),
    "fact": Entity("participants", {
        **PARTICIPANT_FIELDS, **{c: same(f"event.{c}") for c in [*EVENT_COLUMNS, "status_id"]},
        **{site_role(c): same(f"site.{c}") if c in SITE_OTHER else text(f"site.{c}") for c in SITE_COLUMNS if c != "site_id"}},
        {"event": Link("event", "event_id", "event_id", how="inner"), **PARTICIPANT_LINKS, "site": Link("site", "site_id", "site_id")}),
})


def _discreet(df: DataFrame, personal: bool) -> DataFrame:
    """Identity numbers masked, unless personal data was asked for."""
    if personal or "identity_no" not in df.columns:
        return df
    return df.withColumn("identity_no", mask_identity("identity_no"))


def _shown(columns: Iterable[str], personal: bool) -> list[str]:
    return [c for c in columns if personal or c not in CONTACT_COLUMNS]


def address_lookup(sites: DataFrame, addresses: DataFrame, districts: DataFrame, trim: bool = True) -> DataFrame:
    """Sites with district, address and postcode, one row per address; a
    site without an address has one row."""
    one = GRAPH.extended("address", {"address": Field(("address1", "address2"), lambda a, b: address_line(a, b, trim))})
    a = one.plan({"addresses": addresses, "districts": districts}, "address", ["site_id", *ADDRESS_COLUMNS], UNIQUE)
    return sites.join(a, "site_id", "left")


def site_full(t: Source, columns: list[str] | None = None, graph: Graph = GRAPH, unique: Iterable[str] = UNIQUE) -> DataFrame:
    """Every site profile with its organisations, area, address and
    equipment."""
    return graph.plan(t, "site", columns or SITE_COLUMNS, unique)


def event_taxonomy(t: Source, by: str = "program", columns: list[str] | None = None, graph: Graph = GRAPH,
                   unique: Iterable[str] = UNIQUE) -> DataFrame:
    """One row per event: category, module and program, names never null,
    start and last date.  Category and module are those of the program
    (``by="program"``) or of the event's own keys (``by="event"``)."""
    out = columns or ["event_id", "event_category", "program_module", "program", "program_name", "event_startdate", "event_lastdate",
                      "program_method", "event_description", "requester_id"]
    via = {"event_category": "by_program_category", "program_module": "by_program_module"} if by == "program" else {}
    df = graph.plan(t, "event", [via.get(c, c) for c in out], unique)
    return df.withColumnsRenamed({v: c for c, v in via.items()}).distinct()


def event_details(t: Source, columns: list[str] | None = None, graph: Graph = GRAPH, unique: Iterable[str] = UNIQUE) -> DataFrame:
    """Events with their own taxonomy ids resolved, and their creator."""
    return graph.plan(t, "event", columns or ["event_id", *EVENT_COLUMNS], unique)


def home_sites(t: Source, graph: Graph = GRAPH, unique: Iterable[str] = UNIQUE) -> DataFrame:
    """Members' registered sites, by id."""
    return graph.plan(t, "home", ["id", *HOME_COLUMNS], unique)


def participant_details(t: Source, columns: list[str] | None = None, personal: bool = False, graph: Graph = GRAPH,
                        unique: Iterable[str] = UNIQUE) -> DataFrame:
    """Participants with member, child and home site; a gender in either
    role, and the one that a report shows (the member's, else the child's)."""
    return _discreet(graph.plan(t, "participant", columns or _shown(PARTICIPANT_COLUMNS, personal), unique), personal)


def build_fact(t: Source, columns: list[str] | None = None, excluded_events: DataFrame | None = None, personal: bool = False,
               graph: Graph = GRAPH, unique: Iterable[str] = UNIQUE) -> DataFrame:
    """Events joined with their participants (inner), with the event's site
    under the prefix ``event_site_`` and the member's under ``home_``.

    Only the lookups that ``columns`` need are planned, besides those that
    may multiply rows.  The join's exchanges stay with the planner, so a hot
    event's partition can be split."""
    if excluded_events is not None:
        t = ChainMap({"events": t["events"].join(excluded_events.select("event_id"), "event_id", "left_anti")}, t)
    return _discreet(graph.plan(t, "fact", columns or _shown(FACT_COLUMNS, personal), unique), personal)


def participants_with_events(participants: DataFrame, events: DataFrame, key: str = "event_id", order: list[str] | None = None) -> DataFrame:
    """Every participant row with its event's columns: events are reduced to
    one row per key (the first by ``order``), and a participant of an
    unknown event stays."""
    one = dedupe_first(events, [key], order or [c for c in events.columns if c != key])
    return participants.join(one, key, "left")


def strip_control_everywhere(df: DataFrame) -> DataFrame:
    """Control characters taken out of every text column, in one select."""
    from ..functions.text import strip_control

    return df.select(*[strip_control(c).alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes])


FACT_ORDER = ["event_site_state", "event_site_name", "event_startdate", "event_id", "participant_name", "participant_id"]


def sort_fact(fact: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The fact's report order, nulls last; participant_id breaks ties."""
    return fact.orderBy(*[F.col(c).asc_nulls_last() for c in order or FACT_ORDER if c in fact.columns])
