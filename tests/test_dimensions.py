"""Set-based dimensions against a plain loop over the rows in order."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from footlights.operators import dimensions

AS_OF = dt.datetime(2026, 1, 1)
DAY = dt.datetime(2020, 1, 1)
STAGED = "id long, source_id string, theater_id string, venue string, city string, country string, timezone string, company string, choreographer string, choreographer_nationality string, work string, work_is_story boolean, program string, tags array<string>, genre string"


def slug(s):
    return re.sub(r"^-+|-+$", "", re.sub(r"[^a-z0-9]+", "-", (s or "").lower()))


def key(s):
    return slug(s) or "=" + s.strip().lower()


def grams(s):
    return {("  " + w + " ")[i : i + 3] for w in s.split("-") if w for i in range(len(w) + 1)}


def score(a, b):
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 0.0


def close(a, b):
    return bool(a and b) and (score(a, b) >= 0.6 or len(b) >= 5 and b in a or len(a) >= 5 and a in b)


def filled(s):
    return s if s and s.strip() else None


def loop(rows, theaters, companies, people, works, programs, sources):
    """What a run over the rows in order gives: ids by name of the entry, notes. Entries are lists; the first fits first."""
    out = {}
    for r in sorted(rows, key=lambda r: r["id"]):
        notes, src = [], sources.get(r["source_id"], {})
        t = r["theater_id"] or (None if filled(r["venue"]) else src.get("theater_id"))
        if t is None and filled(r["venue"]):
            v = r["venue"]
            hit = next((x for x in theaters if slug(v) and slug(v) in {slug(n) for n in [x["name"], *x["aliases"]]} or key(v) == key(x["name"])), None)
            if hit is None:
                near = [x for x in theaters if r["city"] and x["city"] and x["city"].lower() == r["city"].lower() and close(slug(x["name"]), slug(v))]
                if near:
                    hit = max(near, key=lambda x: (score(slug(x["name"]), slug(v)), x["id"]))
                    hit["aliases"].append(v.strip())
                    notes.append("venue matched by close name: " + v)
            if hit is None:
                hit = {"id": "venue:" + key(v), "name": v.strip(), "city": r["city"], "aliases": []}
                theaters.append(hit)
                notes.append("new venue: " + v)
            t = hit["id"]
        named = []
        for column, entries, label in (("company", companies, "company"), ("choreographer", people, "choreographer")):
            found = src.get("company_id") if column == "company" and not filled(r[column]) else None
            if filled(r[column]):
                hit = next((x for x in entries if key(r[column]) in {key(n) for n in [x["name"], *x["aliases"]]}), None)
                if hit is None:
                    hit = {"id": f"{label}:" + key(r[column]), "name": r[column].strip(), "aliases": []}
                    entries.append(hit)
                    notes.append(f"new {label}: " + r[column])
                found = hit["id"]
            named.append(found)
        company, person = named
        work = program = None
        if filled(r["work"]):
            same = [w for w in works if key(w["title"]) == key(r["work"])]
            fits = [w for w in same if w["who"] is None] if r["work_is_story"] else sorted((w for w in same if person is None or w["who"] in (person, None)), key=lambda w: person is None or w["who"] != person)
            if not fits:
                fits = [{"id": f"work:{key(r['work'])}:{None if r['work_is_story'] else person}", "title": r["work"].strip(), "who": None if r["work_is_story"] else person}]
                works += fits
                notes.append("new work: " + r["work"])
            work = fits[0]["id"]
        if filled(r["program"]):
            fits = [g for g in programs if key(g["title"]) == key(r["program"]) and company in (None, g["who"])]
            if not fits:
                fits = [{"id": f"program:{key(r['program'])}:{company}", "title": r["program"].strip(), "who": company}]
                programs += fits
                notes.append("new program: " + r["program"])
            program = fits[0]["id"]
        out[r["id"]] = (t, company, person, work, program, notes)
    return out


def frames(spark, theaters, companies, people, works, programs, sources):
    at = lambda k: DAY + dt.timedelta(days=k)
    make = lambda rows, shape: spark.createDataFrame(rows, shape)
    names = "id string, name string, aliases array<string>, created_at timestamp"
    return (
        make([(x["id"], x["name"], x["aliases"], x["city"], at(k)) for k, x in enumerate(theaters)], "id string, name string, aliases array<string>, city string, created_at timestamp"),
        make([(x["id"], x["name"], x["aliases"], at(k)) for k, x in enumerate(companies)], names),
        make([(x["id"], x["name"], x["aliases"], at(k)) for k, x in enumerate(people)], names),
        make([(x["id"], x["title"], x["who"], at(k)) for k, x in enumerate(works)], "id string, title string, choreographer_id string, created_at timestamp"),
        make([(x["id"], x["title"], x["who"], at(k)) for k, x in enumerate(programs)], "id string, title string, company_id string, created_at timestamp"),
        make([(k, v["kind"], v.get("theater_id"), v.get("company_id")) for k, v in sources.items()], "id string, kind string, theater_id string, company_id string"),
    )


def known():
    return (
        [{"id": "t1", "name": "Grand Opera", "city": "Lyon", "aliases": ["Old House"]}, {"id": "t2", "name": "Grand Opera", "city": "Rome", "aliases": []}, {"id": "t3", "name": "City Stage", "city": "lyon", "aliases": []}],
        [{"id": "c1", "name": "Royal Ballet", "aliases": ["RB"]}],
        [{"id": "p1", "name": "Ann Lee", "aliases": []}],
        [{"id": "w1", "title": "Giselle", "who": None}, {"id": "w2", "title": "Swan", "who": "p1"}],
        [{"id": "g1", "title": "Evening", "who": "c1"}],
        {"s1": {"kind": "Opera house", "theater_id": "t3", "company_id": "c1"}, "s2": {"kind": "Dance company", "company_id": "c1"}},
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_a_loop(spark, seed):
    rnd = random.Random(seed)
    venues = [None, " ", "grand  opera", "Grand Opera House", "Opera Nova", "Opera Nova Big", "Nova Big Hall", "Big Hall", "Old house", "City Stages", "City Stage Annex", "Stage Annex Two", "???", " New Place"]
    rows = []
    for i in range(160):
        rows.append(
            {
                "id": i * 3 + 1, "source_id": rnd.choice([None, "s1", "s2", "s9"]), "theater_id": rnd.choice([None] * 9 + ["t9"]), "venue": rnd.choice(venues), "city": rnd.choice(["Lyon", "LYON", "Rome", None]),
                "country": rnd.choice(["France", None]), "timezone": rnd.choice(["Europe/Paris", None]), "company": rnd.choice([None, "", "royal ballet", "R.B.", "RB", "New Co", "new co ", "Other"]), "choreographer": rnd.choice([None, "Ann Lee", "Bo", " bo", "Cy"]),
                "choreographer_nationality": rnd.choice([None, "Danish"]), "work": rnd.choice([None, "Giselle", "Swan", "SWAN!", "Boléro x", "Rite", "rite", "Void", "Moon", "Sun"]), "work_is_story": rnd.choice([None, False, False, True]), "program": rnd.choice([None, "Evening", "Mixed Bill", "mixed bill", "Triple"]),
                "tags": None, "genre": "Ballet",
            }
        )
    for r in rows:
        r["work"] = r["work"] and r["work"].replace("é", "e")
    tables = known()
    given = frames(spark, *known())
    staged = spark.createDataFrame([tuple(r.values()) for r in rows], STAGED).repartition(3)
    got = dimensions.resolve_dimensions(staged, *given, AS_OF)
    want = loop(rows, *tables)
    # new ids are digests: entries are compared by what they stand for
    meant = {r.id: f"venue:{key(r.name)}" for r in got.theaters.select("id", F.col("name")).collect()}
    meant |= {r.id: f"{kind}:{key(r['name'])}" for kind, df in (("company", got.companies), ("choreographer", got.choreographers)) for r in df.collect()}
    meant |= {r.id: f"work:{key(r.title)}:{meant.get(r.choreographer_id, r.choreographer_id)}" for r in got.works.collect()}
    meant |= {r.id: f"program:{key(r.title)}:{meant.get(r.company_id, r.company_id)}" for r in got.programs.collect()}
    name = lambda x: meant.get(x, x)
    plain = lambda x: x and re.sub(r"^(work|program):([^:]*):(.*)$", lambda m: f"{m[1]}:{m[2]}:{m[3]}", x)
    for r in got.rows.collect():
        assert (*(name(r[c]) for c in dimensions.DIMENSIONS), r.notes) == (*(plain(x) for x in want[r.id][:5]), want[r.id][5]), (r, want[r.id])
    created = [x for t in tables[:5] for x in t if ":" in x["id"]]
    assert len(meant) == len(created)
    assert sorted(tuple(r) for r in got.aliases.select("alias").collect()) == sorted((a,) for t in tables[0] for a in t["aliases"] if a not in ("Old House",))
    # a second run over what the first has made makes nothing
    aliases = {r.theater_id: r.a for r in got.aliases.groupBy("theater_id").agg(F.collect_list("alias").alias("a")).collect()}
    more = spark.createDataFrame([(k, v) for k, v in aliases.items()], "_t string, more array<string>")
    venues_now = given[0].unionByName(got.theaters.select("id", "name", F.array().cast("array<string>").alias("aliases"), "city", "created_at"))
    venues_now = venues_now.join(more, F.col("id") == F.col("_t"), "left").withColumn("aliases", F.concat("aliases", F.coalesce("more", F.array().cast("array<string>")))).drop("_t", "more")
    none = F.array().cast("array<string>").alias("aliases")
    again = dimensions.resolve_dimensions(
        staged, venues_now, given[1].unionByName(got.companies.select("id", "name", none, "created_at")), given[2].unionByName(got.choreographers.select("id", "name", none, "created_at")),
        given[3].unionByName(got.works.select("id", "title", "choreographer_id", "created_at")), given[4].unionByName(got.programs.select("id", "title", "company_id", "created_at")), given[5], AS_OF,
    )
    assert [df.count() for df in (again.theaters, again.companies, again.choreographers, again.works, again.programs)] == [0] * 5
    assert again.rows.where("id = 1").count() == 1


def test_leaders_in_rounds(spark):
    """A chain of 9 neighbours: every second one leads; a taken node leads nobody."""
    nodes = spark.createDataFrame([(str(k), k != 6) for k in range(9)] + [("x", True)], "key string, free boolean")
    edges = spark.createDataFrame([(str(k), str(k + 1)) for k in range(8)], "early string, late string")
    assert {r.key for r in dimensions.leaders(nodes, edges).where("leads").collect()} == {"0", "2", "4", "7", "x"}


def test_empty_staging(spark):
    got = dimensions.resolve_dimensions(spark.createDataFrame([], STAGED), *frames(spark, *known()), AS_OF)
    assert got.rows.count() == 0 and got.theaters.count() == 0 and got.works.count() == 0
