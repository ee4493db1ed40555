"""Operators on small hand-made rows: the cases that the demo tables don't hold."""

import datetime as dt
import json
import math

import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from stintgraph.functions import agency, names, prepare
from stintgraph.operators import candidates, gates, scoring, search, sync
from stintgraph.plans import registry, resolve
from stintgraph.sources import tables
from stintgraph.streaming import ingest

AS_OF = dt.date(2024, 6, 1)


def value(spark, column, **row):
    cells = [F.lit(v).alias(k) for k, v in row.items()] or [F.lit(1).alias("x")]
    return spark.range(1).select(*cells).select(column.alias("v")).first().v


def stint(person, first, last, start="2010-01-01", end="2020-01-01", agency="Hayward Police Department", state="california", kind="POLICE", county=None, k=0):
    return (person, first, "", last, "", agency, kind, start, end, state, county, k)


EMP = "post_person_nbr string, post_first_name string, post_middle_name string, post_last_name string, post_suffix string, post_agency_name string, post_agency_type string, post_start_date string, post_end_date string, state string, county string, rec_ord int"
MEN = "mention_id int, mention_uid string, mention_first_name string, mention_middle_name string, mention_last_name string, mention_suffix string, state string, mention_agency string, mentioned_agencies string, mention_agency_type string, incident_year int"


def emp(spark, *rows):
    rows = [(*r[:11], i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, EMP)
    return tables.with_keys(df.withColumns({c: F.to_date(c) for c in ("post_start_date", "post_end_date")}))


def men(spark, *rows):
    full = [(i, uid, first, "", last, "", state, agency, listed, "POLICE", year) for i, (uid, first, last, state, agency, listed, year) in enumerate(rows)]
    return spark.createDataFrame(full, MEN)


@pytest.mark.parametrize(("start", "end", "year", "fits"), [
    ("2010-01-01", "2020-01-01", 2015, True), ("2018-01-01", "2020-01-01", 2015, False), ("2010-01-01", None, 2023, True),
    ("2010-01-01", "1900-01-01", 2023, True), (None, "2020-01-01", 2015, False), ("2016-05-05", "2020-01-01", 2015, True), ("2000-01-01", "2014-01-01", 2015, True),
])
def test_date_range(spark, start, end, year, fits):
    day = lambda x: F.lit(x).cast("date")
    assert value(spark, candidates.in_date_range(day(start), day(end), F.lit(year), AS_OF)) is fits


@pytest.mark.parametrize(("given", "state"), [("CA", "california"), (" ca ", "california"), ("California", "california"), ("DC", "columbia"), ("New York", "new york"), ("ZZ", "zz"), ("", None), (None, None)])
def test_states(spark, given, state):
    assert value(spark, names.normal_state(F.col("s").cast("string")), s=given) == state
    assert names.normal_state_of(given) == state


def test_similarity(spark):
    a, b = F.lit("MEDINA"), F.lit("MENDEZ")
    got = {k: value(spark, c) for k, c in names.string_features(a, b).items()}
    assert got["jaro"] == pytest.approx(0.6944, abs=1e-4) and got["levenshtein"] == pytest.approx(1 / 3) and got["length_ratio"] == 1
    assert value(spark, names.jaro_winkler(F.lit("martha"), F.lit("marhta"))) == pytest.approx(0.9611, abs=1e-4)
    null = F.lit(None).cast("string")
    assert [value(spark, c) for c in names.string_features(a, null).values()] == [0, 1, 0]
    assert [value(spark, c) for c in names.string_features(F.lit(""), F.lit("")).values()] == [0, 1, 1]


def test_cosine(spark):
    c = lambda a, b: value(spark, names.cosine(F.array(*map(F.lit, a)), F.array(*map(F.lit, b))))
    assert c([1.0, 0.0], [1.0, 0.0]) == 1 and c([1.0], [1.0, 2.0]) == 0 and c([0.0, 0.0], [1.0, 1.0]) == 0


@pytest.mark.parametrize(("name", "le", "non"), [
    ("Alameda District Attorney", False, True), ("County Coroner", False, True), ("Kern DA", False, True), ("Sheriff's Office / DA", True, False),
    ("", False, False), (None, False, False), ("Damascus Library", False, False), (" me ", False, True),
])
def test_agency_kinds(spark, name, le, non):
    c = F.lit(name).cast("string")
    assert value(spark, agency.is_le(c)) is le and value(spark, agency.is_non_le(c)) is non


@pytest.mark.parametrize(("listed", "want"), [
    ("['Oakland Police Department', 'CHP']", ["X", "Oakland Police Department", "CHP"]), ("", ["X"]), ("  ", ["X"]), (None, ["X"]),
    ("Some Agency", ["X", "Some Agency"]), ("[]", ["X"]), ("['A', None, '']", ["X", "A"]),
    ("['None Such PD', 'B']", ["X", "None Such PD", "B"]), ("['a',]", ["X", "a"]), ('''['O\\'Brien, PD', "it's"]''', ["X", "O'Brien, PD", "it's"]), ("['a'", ["X", "['a'"]),
    ("[1, 0, None, 'b']", ["X", "1", "b"]), ("('a',)", ["X", "('a',)"]),
])
def test_agency_lists(spark, listed, want):
    assert value(spark, agency.to_check(F.lit("X"), F.lit(listed).cast("string"))) == want


@pytest.mark.parametrize(("source", "listed", "post", "answer", "valid", "reason"), [
    ("Kern DA", "", "Kern Police", "MATCH", False, agency.GUARD_REASON), ("Kern DA", "Kern Police", "Kern Police", "MATCH", True, ""),
    ("Kern DA", "", "Fresno DA", "match", True, ""), ("Kern Police", "", "", "MATCH", False, agency.EMPTY_POST), ("", "", "Kern Police", "MATCH", False, agency.NOTHING_TO_COMPARE),
    ("Kern Police", "", "Bay Police", "NO_MATCH", False, agency.NOT_VALIDATED),
])
def test_validation(spark, source, listed, post, answer, valid, reason):
    got = value(spark, agency.validation(F.lit(source), F.lit(listed), F.lit(post), lambda a, p: F.lit(answer)))
    assert (got.valid, got.reason) == (valid, reason)


def test_prompt_lists_agencies(spark):
    got = value(spark, agency.prompt(F.array(F.lit("A"), F.lit("B")), F.lit("P")))
    assert "- A\n- B" in got and "P" in got


@pytest.mark.parametrize(("dates", "year"), [
    ("2010-01-01, 2019-05-05, 2015-03-03", 2019), ("3/4/2018", 2018), ("03-04-2017", 2017), ("2016/1/2", 2016), ("1999", 1999),
    ("about 1987 or 1990", 1987), ("nothing", None), ("", None), (None, None), (" , ", None),
])
def test_recent_year(spark, dates, year):
    assert value(spark, prepare.recent_year(F.lit(dates).cast("string"))) == year


def test_uid(spark):
    row = spark.createDataFrame([(" Scott ", "Lunger", 2015)], "first_name string, last_name string, incident_year int")
    same = spark.createDataFrame([("Scott", "Lunger", "2015", "")], "first_name string, last_name string, incident_year string, source_agency string")
    uid = lambda d: d.select(prepare.officer_uid(d).alias("u")).first().u
    assert len(uid(row)) == 64 and uid(row) == uid(same) != uid(row.withColumn("last_name", F.lit("Other")))


def test_mentions_from_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text("first_name,last_name,incident_date,source_agency,state\nScott,Lunger,\"2014-01-01, 2015-07-22\",Hayward PD,\nAnn,Bee,,X,NV\n")
    rows = tables.read_mentions(spark, str(tmp_path / "m.csv"), default_state="california").collect()
    assert [(r.mention_first_name, r.incident_year, r.state, r.mention_incident_date) for r in rows] == [("SCOTT", 2015, "california", dt.date(2015, 1, 1))]
    with pytest.raises(ValueError):
        prepare.with_incident_year(spark.range(1))
    (tmp_path / "n.csv").write_text("last_name\n smith \nSMITH\n")
    assert [r.last_name for r in tables.read_last_names(spark, str(tmp_path / "n.csv")).collect()] == ["SMITH"]


def test_times(spark):
    assert str(value(spark, prepare.naive_timestamp(F.lit("2010-01-01T05:00:00-08:00")))) == "2010-01-01 05:00:00"
    assert value(spark, prepare.naive_timestamp(F.lit("soon"))) is None
    assert str(value(spark, prepare.utc_timestamp(F.lit("2010-12-31T20:00:00-08:00")))) == "2011-01-01 04:00:00"


def test_search_wildcards_and_pages(spark):
    e = emp(spark, stint("P1", "Ann", "Lee"), stint("P2", "Anna", "L_e"), stint("P3", "Bob", "Lee"))
    assert search.search(e, search.Search(first_name="an", last_name="l_e")).count() == 2
    assert [r.rec_ord for r in search.search(e, search.Search(offset=1, limit=1)).collect()] == [1]
    assert search.search(e, search.Search(limit=0)).count() == 3 and search.count(e, search.Search(state="CA")).first().n == 3
    with pytest.raises(ValueError):
        search.search_summary(e, search.Search())


def test_same_name_is_a_prefix_and_uniqueness_is_not(spark):
    e = emp(spark, stint("P1", "Scott", "Lunger"), stint("P2", "SCOTT", "Lungerford"), stint(None, "Scott", "Lunger"))
    m = men(spark, ("M0", "SCOTT", "LUNGER", "california", "A", "", 2015), ("M1", "", "LUNGER", "california", "A", "", 2015), ("M2", "SCOTT", "LUNGER", None, "A", "", 2015))
    assert {r.mention_id: r.n for r in search.same_name_count(m, e).collect()} == {0: 3, 1: 0, 2: 3}
    asked = spark.createDataFrame([("scott", "lunger"), ("No", "One")], "first_name string, last_name string")
    assert {r.first_name: r.n for r in search.name_uniqueness(asked, e).collect()} == {"scott": 2, "No": 0}


def test_nets_union_and_first_wins(spark):
    e = emp(spark, stint("P1", "Scott", "Lunger"), stint("P1", "Scott", "Lunger"), stint("P2", "Scotty", "Lunger"), stint("P3", "Michael", "Brown"), stint("P4", "Scott", "Lundgren"))
    m = men(spark, ("M0", "SCOTT", "LUNGER", "california", "A", "", 2015), ("M0", "SCOTT", "LUNGER", "california", "A", "", 2015))
    got = search.candidate_net(m, e).collect()
    assert sorted((r.mention_id, r.rec_ord, r.net) for r in got) == [(i, *x) for i in (0, 1) for x in ((0, 1), (2, 1), (4, 2))]


def test_county_keeps_persons_and_types_need_a_mix(spark):
    e = emp(spark, stint("P1", "Scott", "Lunger", county="Alameda"), stint("P1", "Scott", "Lunger", start="2011-01-01", county="Contra Costa"),
            stint("P2", "Scott", "Lunger", county="Riverside"), stint("P3", "Scott", "Lunger", kind="CORRECTIONS", county="Alameda"))
    m = men(spark, ("M0", "SCOTT", "LUNGER", "california", "A", "", 2015)).withColumn("m_county", F.lit("Alameda"))
    got = candidates.select_candidates(search.candidate_net(m, e), AS_OF, "m_county").collect()
    assert sorted(r.rec_ord for r in got) == [0, 1]
    inmate = m.withColumn("mention_agency_type", F.lit("CORRECTIONS"))
    assert [r.rec_ord for r in candidates.select_candidates(search.candidate_net(inmate, e), AS_OF, "m_county").collect()] == [3]


def test_blank_first_name_stands_for_z(spark):
    e = emp(spark, stint("P1", "Z", "Lunger"), stint("P2", "Zed", "Lunger"))
    m = men(spark, ("M0", "", "LUNGER", "california", "A", "", 2015))
    net = search.candidate_net(m, e)
    assert [r.post_person_nbr for r in net.select("*").where(candidates.name_net()).collect()] in ([], ["P1"])


def test_every_mention_is_searched(spark):
    at = "/root/testdata/sf0.001"
    asked, sql = registry.queries(), registry.oracle_sql()
    m = registry.Data(spark, at).m
    bare = {r.mention_uid for r in m.where("state is null").collect()}
    found = {r.mention_uid: r.n_candidates for r in asked["flagship_every"](spark, at).collect()}
    own = {r.mention_uid: r.n_candidates for r in asked["flagship"](spark, at).collect()}
    assert bare and any(found[x] for x in bare) and not any(own[x] for x in bare)
    assert all(found[x] == own[x] for x in own.keys() - bare)
    assert asked["batch_candidate_meta_every"](spark, at).first().total_mentions == m.count() > asked["batch_candidate_meta"](spark, at).first().total_mentions
    assert all(sql[f"{k}_every"] != sql[k] for k in registry.STATED)


def test_short_names_ask_for_less(spark):
    rows = [("P0", "Z", "Lunger", "california"), ("P1", "Zed", "Lunger", "california"), ("P2", "Zed", "Lunger", "texas"), ("P3", "J", "Smith", "california"),
            ("P4", "John", "Smith", "california"), ("P5", "Scott", "Smi", "texas"), ("P6", "Scott", "Lee", "california"), ("P7", "", "", "california")]
    e = emp(spark, *(stint(p, a, b, state=s) for p, a, b, s in rows))
    asked = [("", "LUNGER", "california"), ("J", "SMITH", "california"), ("J", "SMITH", None), ("SCOTT", "S", "california"), ("SCOTT", "S", None),
             ("", "LUNGER", None), (None, None, "texas"), ("", "", None), ("SCOTT", "", "texas"), ("J", "S", "california"), ("SCOTT", "LEE", "california")]
    m = men(spark, *((f"M{i}", *x, "A", "", 2015) for i, x in enumerate(asked)))
    found = {(r.mention_id, r.net, r.post_person_nbr) for r in search.candidate_nets(m, e).collect()}

    def fits(net, a, b, s, first, last, state):
        a, b, first, last = (a or "").lower(), (b or "").lower(), first.lower(), last.lower()
        one = (len(a) < 2 or first[:2] == a[:2]) and (not b or last == b)
        two = (not a or first == a) and (len(b) < 2 or last[:2] == b[:2])
        return (s is None or s == state) and (one if net == 1 else two)

    want = {(i, net, p) for i, (a, b, s) in enumerate(asked) for net in (1, 2) for p, first, last, state in rows if fits(net, a, b, s, first, last, state)}
    assert found == want and {p for i, _, p in found if i == 1} >= {"P3", "P4"}
    net = search.candidate_net(m.where("mention_id = 0"), e)
    assert [r.post_person_nbr for r in net.where(candidates.name_net()).collect()] == ["P0"]


def verdicts(spark, rows, mention, common=(), **more):
    common = spark.createDataFrame([(c,) for c in common], "last_name string")
    v, c = resolve.resolve(men(spark, mention), emp(spark, *rows), common, AS_OF, **more)
    return v.first(), c


LUNGER = ("M0", "SCOTT", "LUNGER", "california", "Hayward PD", "", 2015)


def test_auto_match_and_lists(spark):
    v, c = verdicts(spark, [stint("P1", "Scott", "Lunger"), stint("P1", "Scott", "Lunger", start="2012-01-01"), stint("P2", "Scotty", "Lunger")], LUNGER)
    assert (v.status, v.reason, v.match.post_person_nbr) == ("auto_matched", "", "P1")
    assert [g.name for g in v.gates] == ["State present", "Common last name", "Unique name in state", "Candidates found", "Exact-name match", "Not ambiguous", "Agency validation"]
    assert sorted((r.post_person_nbr, r.is_best, r.agency_valid) for r in c.collect()) == [("P1", True, True)] * 2 + [("P2", False, None)]
    assert [x.post_person_nbr for x in resolve.candidate_lists(c).first().candidates] == ["P1", "P1", "P2"]
    assert [(r.section, r.n) for r in gates.sections(c).orderBy("section").collect()] == [(0, 2), (2, 1)]


@pytest.mark.parametrize(("change", "common", "reason", "n"), [
    ({3: None}, (), gates.NO_STATE, 1), ({}, ("LUNGER",), "Common last name (LUNGER) - requires manual verification", 2),
    ({6: 1900}, (), gates.NO_CANDIDATES, 4), ({1: "SC"}, (), gates.NOT_EXACT, 7), ({4: "Hayward DA"}, (), agency.GUARD_REASON, 7),
])
def test_reviews(spark, change, common, reason, n):
    mention = tuple(change.get(i, x) for i, x in enumerate(LUNGER))
    v, _ = verdicts(spark, [stint("P1", "Scott", "Lunger")], mention, common)
    assert (v.status, v.reason, len(v.gates), v.match) == ("review", reason, n, None)


def test_many_of_a_name(spark):
    rows = [stint("P1", "Scott", "Lunger"), stint("P2", "Scott", "Lunger")]
    assert verdicts(spark, rows, LUNGER)[0].reason == "Multiple persons (2) with same name - needs verification"
    blank = verdicts(spark, [stint("P1", "Scott", "Lunger "), stint("P2", "Scott ", "Lunger")], LUNGER, require_state=False)[0]
    assert [g.name for g in blank.gates][0] == "Common last name"


def test_best_ties_and_ambiguity(spark):
    rows = [(0, "P1", 0.7, 2), (0, "P2", 0.95, 1), (0, "P3", 0.95, 0), (1, "P1", 0.3, 0), (1, "P1", 0.2, 1), (1, None, 0.1, 2)]
    c = spark.createDataFrame(rows, "mention_id int, post_person_nbr string, match_probability double, rec_ord int")
    assert {r.mention_id: r.post_person_nbr for r in gates.best(c).collect()} == {0: "P3", 1: "P1"}
    assert [(r.mention_id, r.n_persons) for r in gates.ambiguous(c).collect()] == [(0, 3)]
    assert c.where(gates.above_threshold(F.col("match_probability"), 0.95)).count() == 0


def test_injected_model(spark):
    c = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "a double, b double")
    got = scoring.scored_by(c, lambda x: pd.Series(x.sum(axis=1)), ["b", "missing", "a"]).collect()
    assert [r.match_probability for r in got] == [3.0, 7.0]
    assert scoring.scored_by(c.limit(0), lambda x: x, ["a"]).count() == 0


def test_features_of_null_middle_names(spark):
    e = emp(spark, stint("P1", "Scott", "Lunger")).withColumn("post_middle_name", F.lit(None).cast("string"))
    row = scoring.features(search.candidate_net(men(spark, LUNGER), e)).first()
    assert [row[f"middle_name_{k}"] for k in ("jaro", "levenshtein", "length_ratio", "embedding")] == [0.5] * 4
    assert row.mention_full_name == "SCOTT  LUNGER " and row.post_full_name == "Scott Lunger " and row.last_name_embedding == pytest.approx(1)


def test_outputs(spark, tmp_path):
    v, c = resolve.resolve(men(spark, LUNGER, ("M1", "ANN", "SMITH", "california", "A", "", 2015), ("M2", "NO", "ONE", "california", "A", "", 2015)),
                           emp(spark, stint("P1", "Scott", "Lunger")), spark.createDataFrame([("SMITH",)], "last_name string"), AS_OF)
    paths = tables.write_outputs(v.join(resolve.candidate_lists(c), "mention_id", "left"), str(tmp_path))
    assert [spark.read.json(paths[k]).count() for k in ("auto_matched", "early_filtered", "failed_entity_resolution")] == [1, 1, 1]
    assert sorted(r.status for r in spark.read.csv(paths["csv"], header=True).collect()) == ["auto_matched", "early_filtered", "review"]
    assert resolve.summary(v).first() == (3, 1, 2)


def test_sync(spark, tmp_path):
    live = spark.createDataFrame([("a", "x", '{"p":1,"q":2}'), ("b", "x", "{}"), ("c", "y", "{}")], "fs_path string, state string, raw string")
    new = spark.createDataFrame([("a", "x", '{"q":2,"p":1}'), ("d", "x", "{}"), ("c", "x", '{"z":1}')], "fs_path string, state string, raw string")
    assert {r.fs_path: r.action for r in sync.diff(live.where("state = 'x'"), new).collect()} == {"a": "keep", "b": "delete", "d": "insert", "c": "insert"}
    after = sync.merged(live, new, ["x"])
    assert {(r.fs_path, r.state) for r in after.collect()} == {("a", "x"), ("d", "x"), ("c", "x")}
    sync.swap_in(after, str(tmp_path / "t"))
    sync.swap_in(sync.append_new(sync.current(spark, str(tmp_path / "t")), live), str(tmp_path / "t"))
    assert {r.fs_path for r in sync.current(spark, str(tmp_path / "t")).collect()} == {"b"}
    docs = spark.createDataFrame([("p", "Ann", ["q"])], "fs_path string, first_name string, searchQueries array<string>")
    row = sync.doc_rows(docs).first()
    assert (row.first_name, row.last_name, row.search_queries) == ("Ann", "", '["q"]')
    meta = spark.createDataFrame([("x", 1), ("y", 2)], "state string, row_count int")
    assert {tuple(r) for r in sync.meta_after(meta, spark.createDataFrame([("x", 9)], "state string, row_count int")).collect()} == {("x", 9), ("y", 2)}


def test_ingest_takes_files_once(spark, tmp_path):
    from stintgraph.streaming.ingest import ingest_available

    src, out, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    spark.range(5).write.parquet(src)
    for _ in range(2):
        ingest_available(spark, src, spark.range(1).schema, out, at)
    assert spark.read.parquet(out).count() == 5
    spark.range(5, 8).write.mode("append").parquet(src)
    ingest_available(spark, src, spark.range(1).schema, out, at)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(8))


def test_ids_and_samples_do_not_follow_partitions(spark):
    rows = spark.createDataFrame([("Ann", f"Bee{i % 7}", "2015") for i in range(40)], "first_name string, last_name string, incident_year string")
    ids = [sorted((r.mention_id, r.mention_last_name) for r in prepare.built_mentions(rows.repartition(n)).collect()) for n in (1, 5)]
    assert ids[0] == ids[1] and len({i for i, _ in ids[0]}) == 40
    samples = [sorted(r.last_name for r in prepare.seeded_sample(rows.repartition(n), 11, 3).collect()) for n in (1, 5)]
    assert samples[0] == samples[1] and len(samples[0]) == 11
    assert prepare.seeded_sample(rows, 100, 3).count() == 40 and samples[0] != sorted(r.last_name for r in prepare.seeded_sample(rows, 11, 4).collect())


def test_one_mention(spark):
    e, common = emp(spark, stint("P1", "Scott", "Lunger"), stint("P2", "Scotty", "Lunger")), spark.createDataFrame([], "last_name string")
    asked = {"first_name": "Scott", "last_name": "Lunger", "incident_date": "2015-07-22", "source_agency": "Hayward PD"}
    got = json.loads(resolve.resolve_one(asked, e, common, AS_OF, default_state="california"))
    assert (got["status"], got["match"]["post_person_nbr"], len(got["candidates"])) == ("auto_matched", "P1", 2) and got["input_officer"]["first_name"] == "SCOTT"
    assert json.loads(resolve.resolve_one(asked | {"last_name": "Nobody"}, e, common, AS_OF, default_state="california"))["candidates"] == []
    with pytest.raises(ValueError):
        resolve.resolve_one(asked | {"incident_date": ""}, e, common, AS_OF)


def test_features_from_file_to_file(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,mention_first_name,mention_last_name,post_first_name,post_last_name\n1,Ann,Lee,Ann,Lee\n2,Ann,Lee,Bob,\n")
    tables.features_file(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"))
    rows = {r.id: r for r in spark.read.csv(str(tmp_path / "out"), header=True).collect()}
    assert float(rows["1"].first_name_jaro) == 1 and float(rows["2"].last_name_jaro) == 0 and float(rows["1"].middle_name_jaro) == 0.5
    (tmp_path / "x.jsonl").write_text('{"id": "a"}\n{"id": "a"}\n{"id": "b"}\n{}\n')
    assert tables.distinct_in_jsonl(spark, str(tmp_path / "x.jsonl"), "id").first() == (4, 2)


def test_search_shows_few(spark):
    e = emp(spark, *(stint(f"P{i}", "Ann", "Lee") for i in range(30)))
    assert search.shown(e, search.Search(first_name="ann")).count() == search.SHOWN and search.shown(e, search.Search(first_name="ann", limit=3)).count() == 3
    with pytest.raises(ValueError):
        search.shown(e, search.Search(state="CA"))
    assert [value(spark, prepare.shown_date(F.lit(x).cast("timestamp"))) for x in ("2020-02-03 04:05:06", None)] == ["2020-02-03", ""]


def test_swap_keeps_the_version_before(spark, tmp_path):
    at = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sync.current(spark, at)
    one = spark.createDataFrame([("a", "x")], "fs_path string, state string")
    sync.swap_in(one, at)
    before = sync.current(spark, at)
    (tmp_path / "t" / "current" / "000000000009-broken").mkdir()  # a name that was never completed
    assert sync.current(spark, at).first().fs_path == "a"
    sync.swap_in(one.withColumn("fs_path", F.lit("b")), at)
    assert sync.current(spark, at).first().fs_path == "b" and before.first().fs_path == "a"
    stats = spark.createDataFrame([("x", 1), ("y", 2)], "state string, last_updated int")
    assert {tuple(r) for r in sync.baseline(spark.createDataFrame([("x", 3)], "state string, n bigint"), stats).collect()} == {("x", 1, 3), ("y", 2, 0)}
    assert {tuple(r) for r in ingest.latest_stats(stats.unionByName(spark.createDataFrame([("x", 7), (None, 9)], "state string, last_updated int"))).collect()} == {("x", 7), ("y", 2)}
    docs = spark.createDataFrame([(f"d{i}",) for i in range(5)], "fs_path string")
    assert [[r.fs_path for r in ingest.page_after(docs, c, 2).collect()] for c in (None, "d1", "d4")] == [["d0", "d1"], ["d2", "d3"], []]


def test_embedding_features(spark):
    """Against counts of hashed n-grams made in Python."""

    def brute(a, b):
        x, y = ([0.0] * 64 for _ in range(2))
        for text, own in ((a, x), (b, y)):
            marked = f"^{text.lower()}$"
            for i in range(max(len(marked) - 2, 1)):
                own[xxhash.xxh64_intdigest(marked[i : i + 3].encode(), 42) % 64] += 1
        norm = math.sqrt(sum(v * v for v in x)) * math.sqrt(sum(v * v for v in y))
        return sum(p * q for p, q in zip(x, y, strict=True)) / norm if norm else 0.0

    e = emp(spark, stint("P1", "Scott", "Lunger"), stint("P2", "Scotty", "Lunger"), stint("P3", "Scott", "Lundgren"))
    rows = scoring.features(search.candidate_net(men(spark, LUNGER), e)).collect()
    assert len(rows) == 3
    for r in rows:
        for part, a, b in (("first", r.mention_first_name, r.post_first_name), ("last", r.mention_last_name, r.post_last_name), ("full", r.mention_full_name, r.post_full_name)):
            assert r[f"{part}_name_embedding"] == pytest.approx(brute(a, b))


def test_searches_find_rows(spark):
    asked = registry.queries()
    assert asked["search_contains"](spark, "/root/testdata/sf0.001").count() > 0 and asked["count_filtered"](spark, "/root/testdata/sf0.001").first().n > 0


def test_empty_tables(spark):
    m, e = men(spark, LUNGER).limit(0), emp(spark, stint("P1", "Scott", "Lunger")).limit(0)
    v, c = resolve.resolve(m, e, spark.createDataFrame([], "last_name string"), AS_OF)
    assert v.count() == 0 and c.count() == 0


def test_nets_hash_join(spark):
    m, e = men(spark, LUNGER), emp(spark, stint("P1", "Scott", "Lunger"))
    plan = search.candidate_net(m, e)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
