import json
import random

from threadtables.operators import authors as A
from threadtables.operators.reshape import unpivot_history, wide_history
from threadtables.plans.authors import author_rows
from threadtables.sources import schemas

from conftest import as_dicts

SITE = "https://site.example"
LINKS = ["homepage", "gscholar", "dblp", "semanticScholar", "orcid", "linkedin", "wikipedia", "aclanthology"]


def profile(query_id, profile_id=None, names=None, expertise=None, history=None, **links):
    content = (names, *[links.get(k) for k in LINKS], expertise, history)
    return (query_id, profile_id or query_id, content)


def job(position, name=None, domain=None, country=None, start=2000, end=2001):
    return (position, start, end, (name, domain, country))


def table(spark, *profiles):
    return A.author_table(spark.createDataFrame(list(profiles), schemas.PROFILES), SITE)


def test_names_links_expertise(spark):
    rows = as_dicts(table(
        spark,
        profile("~1", names=[("A", False), ("B", True), ("C", True)], gscholar="g", homepage="h", dblp=""),
        profile("~2", names=[("A", False), (None, True)], expertise=[(["x", "y"],), (None,), (["y", "z"],)]),
        profile("~3", names=[("A", None)]),
        profile("~4"),
    ), "Link")
    assert [r["Name"] for r in rows] == ["B", "", "A", ""]
    assert rows[0]["Personal Links"] == "Homepage (h); Google Scholar (g)" and rows[1]["Personal Links"] == ""
    assert rows[1]["Expertise"] == "x; y; z" and rows[3]["Expertise"] == ""
    assert rows[0]["Link"] == f"{SITE}/profile?id=~1"


def test_history(spark):
    places = [(n, d, c) for n in (None, "N") for d in (None, "d.x") for c in ("", "CC")]
    shown = ["", "CC", "d.x", "d.x [CC]", "N", "N [CC]", "N (d.x)", "N (d.x) [CC]"]
    jobs = [job(f"p{i}", *p) for i, p in enumerate(places)] + [job(None, start=None, end=None), job("q", start=0, end=0)]
    authors = table(spark, profile("~1", names=[("A", True)], history=jobs), profile("~2"))
    rows = as_dicts(A.long_history(authors), "history_idx")
    assert [r["location"] for r in rows[:8]] == shown
    assert (rows[8]["title"], rows[8]["start"], rows[8]["end"]) == ("", "", "Present")
    assert (rows[9]["start"], rows[9]["end"]) == ("0", "0")
    wide = wide_history(authors)
    assert len(wide.columns) == 4 + 4 * 10
    back = as_dicts(unpivot_history(wide), "history_idx")
    assert [r["history_idx"] for r in back] == [1, 2, 3, 4, 5, 6, 7, 8, 10]
    assert len(wide_history(table(spark, profile("~2"))).columns) == 8


def test_manifest(spark):
    papers = spark.createDataFrame([(["~b", "~a"],), (["~a", "~lost", "~é"],), ([],)], "author_ids array<string>")
    profiles = spark.createDataFrame([profile("~a"), profile("~b", "~a"), profile("~x")], schemas.PROFILES)
    ids = A.distinct_author_ids(papers)
    assert [r[0] for r in ids.collect()] == ["~a", "~b", "~lost", "~é"]
    assert {r["author_id"] for r in A.missing_profiles(ids, profiles).collect()} == {"~lost", "~é"}
    assert author_rows(papers, profiles, SITE).count() == 2
    assert author_rows(papers, profiles, SITE, distinct=True).count() == 1
    assert author_rows(papers, profiles, SITE, keep_missing=True).count() == 4


def test_years_of_any_type_are_shown(spark):
    from threadtables.session import fresh_dir
    from threadtables.sources import readers

    path = fresh_dir(spark, "profiles")
    years = [("2015", "2017"), (2015, 2016.5), (0, None), (None, "now")]
    line = json.dumps({"id": "~a", "content": {"history": [{"position": "p", "start": a, "end": b} for a, b in years]}})
    spark.createDataFrame([(line,)], "value string").write.text(path)
    rows = A.long_history(A.author_table(readers.scan_profiles(spark, path), "https://s")).orderBy("history_idx").collect()
    assert [(r["start"], r["end"]) for r in rows] == [("2015", "2017"), ("2015", "2016.5"), ("0", "Present"), ("", "now")]


def test_merges_are_followed_to_their_end(spark):
    """Random chains, circles and ends that were not requested, against a plain walk."""
    draw = random.Random(5)
    names = [f"~n{i}" for i in range(400)]
    into = {n: draw.choice([n, names[max(0, i - 1)], names[max(0, i - 1)], draw.choice(names), "~gone"]) for i, n in enumerate(names)}
    into |= {f"~long{i}": f"~long{i + 1}" for i in range(70)} | {"~x1": "~x2", "~x2": "~x3", "~x3": "~x1", "~tail": "~x3", "~tail0": "~tail"}
    wanted = {}
    for n in into:
        path, at = [n], into[n]
        while at in into and at not in path:
            path.append(at)
            at = into[at]
        if at not in into:
            wanted[n] = at
        else:
            wanted[n] = at if into[at] == at else min(path[path.index(at):])
    profiles = spark.createDataFrame([(q, i, "x") for q, i in into.items()], "query_id string, id string, name string")
    assert {r["query_id"]: r["profile"] for r in A.merged_profiles(profiles).collect()} == wanted
    kept = A.distinct_profiles(profiles)
    assert kept.columns == profiles.columns
    assert {r["id"] for r in kept.collect()} == set(wanted.values()) and kept.count() == len(set(wanted.values()))
    chain = spark.createDataFrame([("~a", "~b", 1), ("~b", "~c", 2), ("~c", "~c", 3), (None, "~d", 4)], "query_id string, id string, n int")
    assert sorted((r["id"], r["n"]) for r in A.distinct_profiles(chain).collect()) == [("~c", 2), ("~d", 4)]
    assert A.distinct_profiles(chain.limit(0)).count() == 0
