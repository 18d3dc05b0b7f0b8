"""Small inputs in the shapes of the data that the jobs are for."""

import gzip
import json
import tomllib
import zipfile

import pytest
from pyspark.sql import functions as F

from snapquarry.functions import checks as C
from snapquarry.operators import catalog as K
from snapquarry.operators import discover as D
from snapquarry.operators import edges as E
from snapquarry.operators import manifest as M
from snapquarry.plans import reconcile as R
from snapquarry.sources import files as S
from snapquarry.streaming.upsert import latest_version, merge_batch, upsert_stream, versions

FILES = "snapshot string, database string, asset string, dataset string, version_token string, path string, sha256 string, bytes bigint"
SHA = "a" * 64


def col(df, name):
    return sorted(r[name] for r in df.collect())


def test_unsafe_records(spark):
    rows = [("go/v1", "go", "o", None, "v1", p, s, b) for p, s, b in [("/absolute", SHA, 1), ("raw/../escape", SHA, 1), ("tidy/data.tsv", SHA, 1), ("raw/a", "bad", 1), ("raw/b", SHA, None), ("raw/c", SHA, 0), ("raw/d\\e", SHA, 1)]]
    got = {(r.path, r.rule) for r in M.record_issues(spark.createDataFrame(rows, FILES)).collect()}
    assert got == {("/absolute", "path"), ("raw/../escape", "path"), ("tidy/data.tsv", "path"), ("raw/d\\e", "path"), ("raw/a", "sha256"), ("raw/b", "bytes")}


def test_datasets_and_duplicate_identity(spark):
    rows = [(f"x/{k}/v1", "o", "i", d, "v1", "raw/a", SHA, 1) for k, d in enumerate(["collectri", "dorothea", "", " collectri", "collectri"])]
    good, _, issues = M.build_manifest(spark.createDataFrame(rows, FILES))
    got = {(r.snapshot, r.rule, r.detail) for r in issues.collect()}
    assert got == {("x/2/v1", "dataset", ""), ("x/3/v1", "dataset", ""), ("x/4/v1", "duplicate identity", "x/0/v1")}
    assert col(good, "snapshot") == ["x/0/v1", "x/1/v1"]


def test_empty_frames(spark):
    empty = spark.createDataFrame([], FILES)
    good, total, issues = M.build_manifest(empty)
    assert good.count() == 0 and issues.count() == 0 and total.first().file_count is None
    assert R.declared_vs_present(empty.select("path", F.col("bytes").alias("expected_bytes")), empty).count() == 0


def test_overflow_is_an_issue(spark):
    rows = [("g/v1", "g", "o", None, "v1", f"raw/{k}", SHA, 2**63 - 1) for k in range(2)]
    assert [(r.rule) for r in M.build_manifest(spark.createDataFrame(rows, FILES))[2].collect()] == ["overflow"]


def test_record_upsert_drops_vanished(spark):
    s = "path string, bytes bigint"
    got = R.merge_records(spark.createDataFrame([("7070", 11), ("9999", 5)], s), spark.createDataFrame([("9606", 22), ("7070", 12)], s), spark.createDataFrame([("7070", 12), ("9606", 22)], s))
    assert {(r.path, r.bytes) for r in got.collect()} == {("7070", 12), ("9606", 22)}


def edge_rows(spark, rows):
    return spark.createDataFrame(rows, "organism string, source string, target string")


def test_batch_bounds(spark):
    plan = E.plan_edge_batches(edge_rows(spark, [("9606", "S", f"T{k:03d}") for k in range(101)]))
    assert sorted(len(r.targets) for r in plan.collect()) == [1, 100]
    over = E.plan_edge_batches(edge_rows(spark, [("9606", f"S{k}", "T") for k in range(501)])).collect()
    assert over[0].error and len(over) == 1
    assert E.plan_edge_batches(edge_rows(spark, [("9606", "S", "T" * 6144)])).first().error
    odd = E.plan_edge_batches(edge_rows(spark, [("9606", "S", t) for t in (None, " ", "b", "a")])).collect()
    assert [(r.batch, list(r.targets)) for r in odd if not r.error] == [(0, ["a", "b"])] and sum(r.error == "empty target" for r in odd) == 2
    long = E.plan_edge_batches(edge_rows(spark, [("9606", "S", f"{k:03d}" + "é:" * 25) for k in range(39)])).collect()
    assert len(long) > 1 and all(len(r.url) <= 6144 for r in long) and [r.batch for r in long] == list(range(len(long)))


def test_batch_plan_rules(spark):
    """The plan of an inventory breaks no rule; each planted fault is told."""
    edges = edge_rows(spark, [(o, "S", f"T{k:03d}") for o in ("9606", "10090") for k in range(150)])
    plan = E.plan_edge_batches(edges).drop("error").withColumn("leaf", F.col("batch") + F.when(F.col("organism") == "9606", 0).otherwise(10))
    rules = lambda p, asked=("9606", "10090"): {(r.organism, r.batch, r.rule) for r in E.validate_batch_plan(p, edges, asked).collect()}
    assert rules(plan) == set()
    assert ("10090", None, "order") in rules(plan.withColumn("leaf", 20 - F.col("leaf"))) or ("9606", None, "order") in rules(plan.withColumn("leaf", 20 - F.col("leaf")))
    assert {(r[0], r[2]) for r in rules(plan, ("9606",))} == {("10090", "organism")}
    assert {r[2] for r in rules(plan.filter("batch = 0"))} == {"total"}
    assert {r[2] for r in rules(plan.withColumn("targets", F.array().cast("array<string>")))} >= {"targets", "canonical", "counts"} - {"counts"}
    twice = plan.withColumn("targets", F.when(F.col("batch") == 1, F.array_sort(F.concat("targets", F.array(F.lit("T001"))))).otherwise(F.col("targets")))
    assert ("9606", 1, "repeated") in rules(twice)


def test_edge_violations(spark):
    rows = [("9606", "S1", "T1", '{"e":1}', "{}", "A;D"), ("9606", "S2", "T2", "invalid", "{}", "A"), ("9606", "S3", "T1", '{"e":1} x', '{"a":1,"a":2}', "E"), ("9606", "S4", "T1", "{}", "1" * 5000, "")]
    df = spark.createDataFrame(rows, "organism string, source string, target string, evidences string, extra_attrs string, dorothea_level string")
    batches = spark.createDataFrame([("9606", ["T1"])], "organism string, targets array<string>")
    got = {(r.source, r.rule) for r in E.validate_edges(df, batches, "ABCD").collect()}
    assert got == {("S2", "target"), ("S2", "evidences"), ("S3", "evidences"), ("S3", "level"), ("S4", "level")}


def test_scopes(spark):
    """One organism, the reference, both, none, mixed hierarchies; the query's metadata is no scope."""
    rows = [("one", "raw/hsa/a"), ("ref", "raw/reference/a"), ("both", "raw/reference/a"), ("both", "raw/hsa/b"), ("none", "raw/a"), ("mixed", "raw/br/a"), ("mixed", "raw/hsa/b"), ("refs", "raw/br/a"), ("refs", "raw/ko/a"), ("meta", "raw/query_meta.json/x"), ("two", "raw/9606/a"), ("two", "raw/10090/a")]
    df = spark.createDataFrame(rows, "snapshot string, path string")
    got = lambda *a: {r.snapshot: (r.scope_type, r.scope_value) for r in M.scope(df, ["snapshot"], *a).collect()}
    pathway, hierarchy, organism = got("pathway"), got("hierarchy", ("reference", "ko")), got()
    assert [pathway[k] for k in ("one", "ref", "both", "none")] == [("organism", "hsa"), ("reference", "pathway"), ("organisms", "hsa"), ("organisms", "")]
    assert [hierarchy[k] for k in ("one", "mixed", "refs", "none", "two")] == [("organism", "hsa"), ("scopes", "br,hsa"), ("references", "br,ko"), ("reference", "ko"), ("organisms", "10090,9606")]
    assert [organism[k] for k in ("one", "meta", "two")] == [("organism", "hsa"), ("organisms", ""), ("organisms", "10090,9606")]


def test_routing(spark):
    df = spark.createDataFrame([(1, "9606", "-1"), (2, "9606", "9606"), (3, "10090", "9606"), (4, "", "1"), (5, "-1", "-1")], "id int, a string, b string")
    got = {(r.id, r.organism) for r in E.routed(df, "a", "b").collect()}
    assert got == {(1, "9606"), (2, "9606"), (3, "10090"), (3, "9606")}


def test_listings_and_roots(spark):
    lines = spark.createDataFrame([("o", 0, "T01001\thsa\tHomo sapiens"), ("o", 1, "T01002\tmmu; Mus musculus (mouse)"), ("o", 2, "T01001\thsa\tagain"), ("o", 3, " ")], "listing string, pos int, value string")
    assert col(D.listing_ids(lines, "organism"), "id") == ["hsa", "mmu"]
    h = spark.createDataFrame([("b", 0, "br:br08301\tCell growth and death"), ("b", 1, "x")], "listing string, pos int, value string")
    assert col(D.listing_ids(h, "hierarchy"), "id") == ["br08301"] and D.listing_issues(h, "hierarchy").count() == 1
    ids = spark.createDataFrame([("hsa", "hsa00001"), ("hsa", "hsa03010"), ("mmu", "ko00001")], "code string, id string")
    assert col(D.root_pick(ids, "code"), "id") == ["hsa00001", "ko00001"]


def test_links_and_names(spark):
    page = '<a href="../">up</a><a href="extensions/">d</a><a href="go.obo?x=1#y">a</a><a href=\'go%2Bx&amp;.owl\'>b</a><a href="index.html">i</a>'
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    assert col(D.discover_links(df), "name") == ["go+x&.owl", "go.obo"]
    name = spark.createDataFrame([("wikipathways-20260510-gmt-Homo_sapiens.gmt",)], "n string").select(C.pathway_set_name(F.col("n")).alias("p")).first().p
    assert (name.species, name.released) == ("Homo_sapiens", "2026-05-10")


def test_select_assets(spark):
    declared = K.catalog(spark, [("j", "d", "a", "{version}/a", "u/{version}", True, False, 5), ("j", "d", "b", "b", "u", True, True, None)])
    got, issues = K.select_assets(declared, spark.createDataFrame([("a",), ("b",), ("zz",)], "name string"), "v9")
    assert [(r.path, r.url) for r in got.collect()] == [("raw/v9/a", "u/v9")]
    assert {(r.name, r.rule) for r in issues.collect()} == {("zz", "unknown"), ("b", "large")}


def test_shipped_catalogue(spark):
    bases = {"kegg": "https://k/", "dbcan": "https://d", "jaspar": "https://j"}
    rows = K.declared_assets(spark, bases).collect()
    assert len(rows) == 11 + 7 + 4 + 7 and len({(r.database, r.asset, r.name) for r in rows}) == len(rows)
    assert {r.expected_bytes for r in rows if r.database == "dbcan"} == {2177198564, 129842960, 5132429983, 94399}
    chosen, issues = K.select_assets(K.declared_assets(spark, bases).filter("asset = 'metabolic'"), spark.createDataFrame([("module,zz",)], "name string"), "v")
    entries = spark.createDataFrame([("kegg", "metabolic", "module", f"M{k}", k) for k in range(21)] + [("kegg", "metabolic", "module", " ", 99), ("kegg", "metabolic", "enzyme", "E", 1)], "database string, asset string, name string, entry string, pos int")
    got = K.expand_assets(chosen, spark.createDataFrame([("kegg", "metabolic", None)], "database string, asset string, organism string"), entries, bases)
    assert {r.name: r.url for r in got.collect()} == {"module": "https://k/list/module", "module-entry-000001": "https://k/get/" + "+".join(f"M{k}" for k in range(10)), "module-entry-000002": "https://k/get/" + "+".join(f"M{k}" for k in range(10, 20)), "module-entry-000003": "https://k/get/M20"}
    assert [(r.name, r.rule) for r in issues.collect()] == [("zz", "unknown")]
    assert K.expand_assets(chosen.limit(0), got.selectExpr("database", "asset", "'x' AS organism").limit(0), entries.limit(0), bases).count() == 0


def test_request_url_and_header_version(spark):
    url = spark.range(1).select(C.request_url("http://x", {"b": F.lit("a b*~"), "a": F.lit("1,2")}).alias("u")).first().u
    assert url == "http://x?a=1%2C2&b=a+b%2A~"
    lines = spark.createDataFrame([("f", 0, "format"), ("f", 1, "data-version: releases/2026-01-23"), ("g", 0, "data-version: 5")], "file string, pos int, value string")
    assert {(r.file, r.version) for r in D.header_version(lines).collect()} == {("f", "2026-01-23"), ("g", "5")}


LOCK = 'database = "go"\nasset = "ontology"\nversion_token = "v1"\n[[files]]\npath = "raw/a"\nsha256 = "{}"\nbytes = 7\n'


def test_locks_on_disk(spark, tmp_path):
    for d in ("go/v1", "go/v1/sub", "go/v2/raw/x", "s/v1/tidy"):
        (tmp_path / d).mkdir(parents=True)
        (tmp_path / d / "manifest.lock").write_text(LOCK.format(SHA))
    (tmp_path / "bad/v1").mkdir(parents=True)
    (tmp_path / "bad/v1/manifest.lock").write_text("not = = toml")
    locks = S.prune_nested(S.scan_locks(spark, str(tmp_path)))
    rows = {r.path.split(str(tmp_path))[-1]: r for r in locks.collect()}
    assert set(rows) == {"/go/v1/manifest.lock", "/bad/v1/manifest.lock"}
    assert rows["/bad/v1/manifest.lock"].error and rows["/go/v1/manifest.lock"].files[0].bytes == 7
    assert S.lock_files(locks.filter("error is null")).count() == 1


def test_inventory_and_verifiers(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"hello")
    (tmp_path / "empty").write_bytes(b"")
    (tmp_path / ".hidden").write_bytes(b"h")
    (tmp_path / "x.part").write_bytes(b"x")
    inv = {r.path.rsplit("/", 1)[1]: r for r in S.file_inventory(spark, str(tmp_path)).collect()}
    assert inv["empty"].sha256 == S.EMPTY_SHA256 and inv["a.txt"].bytes == 5 and "x.part" not in inv
    steps = {r.path.rsplit("/", 1)[1]: r for r in S.file_inventory(spark, str(tmp_path), largest=4).collect()}
    assert {k: (r.sha256, r.md5) for k, r in steps.items()} == {k: (r.sha256, r.md5) for k, r in inv.items()} and inv["a.txt"].md5 == "5d41402abc4b2a76b9719d911017c592"
    z = tmp_path / "z"
    z.mkdir()
    whole = gzip.compress(b"data" * 100)
    (z / "ok.gz").write_bytes(whole)
    (z / "cut.gz").write_bytes(whole[:-9])
    with zipfile.ZipFile(z / "a.zip", "w") as f:
        f.writestr("m.xml", "x")
    df = spark.read.format("binaryFile").load(str(z))
    ok = {r.path.rsplit("/", 1)[1]: r.ok for r in S.gzip_intact(df).collect()}
    assert ok == {"ok.gz": True, "cut.gz": False, "a.zip": False}
    assert {r.path.rsplit("/", 1)[1] for r in S.zip_member_ok(df, "m.xml").collect() if r.ok} == {"a.zip"}


def test_tables_on_disk(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('source\ttarget\na\t{"x": "y"}\r\nshort\n')
    rows, bad = S.read_strict_tsv(spark, str(tmp_path / "t.tsv"), ["source", "target"])
    assert [tuple(r) for r in rows.collect()] == [("a", '{"x": "y"}')] and [r.rule for r in bad.collect()] == ["width"]
    assert S.read_strict_tsv(spark, str(tmp_path / "t.tsv"), ["source", "wrong"])[1].filter("rule = 'header'").count() == 1
    with gzip.open(tmp_path / "e.tsv.gz", "wt") as f:
        f.write("enzyme\tx\tncbi_tax_id\nP12345\t1\t10090\nshort\n")
        f.write("2\tenzyme\t9606\n")
    got, bad = S.read_edge_archive(spark, str(tmp_path / "e.tsv.gz"), ["enzyme", "ncbi_tax_id"])
    assert sorted(tuple(r) for r in got.collect()) == [("2", "9606"), ("P12345", "10090")] and bad.count() == 0
    assert S.read_edge_archive(spark, str(tmp_path / "e.tsv.gz"), ["enzyme", "none"])[1].count() == 1
    (tmp_path / "l.txt").write_text("b\n\na\n")
    assert [(r.pos, r.value) for r in S.read_listing(spark, str(tmp_path / "l.txt")).orderBy("pos").collect()] == [(0, "b"), (2, "a")]


def test_sidecars_and_sinks(spark, tmp_path):
    for n, v in (("a.json", '{"schema": "full-evidence-v1"}'), ("b.json", '{"schema": "x"}'), ("c.json", "{"), ("d.tsv", "argument\tvalues\ndatasets\ta;b\n")):
        (tmp_path / n).write_text(v)
    kinds = {r.file: r.kind for r in S.classify_sidecars(S.read_sidecars(spark, str(tmp_path))).collect()}
    assert kinds == {"a.json": "full-evidence-v1", "b.json": "unsupported", "c.json": "malformed", "d.tsv": "legacy-basic"}
    df = spark.createDataFrame([("9606", '{"a": "b"}'), ("10090", "x")], "organism string, j string")
    S.write_by_organism(df, str(tmp_path / "out"))
    text = next((tmp_path / "out/taxid=9606").glob("*.csv")).read_text()
    assert text == 'organism\tj\n9606\t{"a": "b"}\n'
    snapshots = spark.createDataFrame([("b", 'q"t', "v1", "b/v1", 3), ("a", "x", "v2", "a/v2", 4)], "database string, asset string, version_token string, snapshot string, file_count int")
    S.write_manifest(snapshots, str(tmp_path / "m"), resource_root="/data")
    tsv = [x for k, p in enumerate(sorted((tmp_path / "m/tsv").glob("*.csv"))) for x in p.read_text().splitlines()[k > 0 :]]
    assert tsv[0].split("\t") == list(S.MANIFEST_COLUMNS) and len(tsv[0].split("\t")) == 22 and tsv[1].startswith("2\t/data\ta\tx\t\tv2\t\ta/v2\t\t4\t0\t")
    toml = tomllib.loads("".join(p.read_text() for p in sorted((tmp_path / "m/toml").glob("*.txt"))))
    assert toml["resource_root"] == "/data" and [(s["database"], s["asset"], s["version"], s["file_count"]) for s in toml["snapshots"]] == [("a", "x", "v2", 4), ("b", 'q"t', "v1", 3)]
    assert "dataset" not in toml["snapshots"][0] and toml["snapshots"][0]["manifest"]["bytes"] == 0
    assert sorted(r.Database for r in spark.read.json(str(tmp_path / "m/json")).collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="xml"):
        S.write_manifest(snapshots, str(tmp_path / "n"), ["tsv", "xml"])


def test_sinks_keep_their_order(spark, tmp_path):
    """Several parts, one after another, are the sorted document (O1); records and issues in order (O2, O3, O5)."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(f"d{k * 7 % 50:02d}", f"a{k % 3}", None if k % 5 else "x", "v1", f"d/{k}/v1", k) for k in range(300)]
        df = spark.createDataFrame(rows, "database string, asset string, dataset string, version_token string, snapshot string, file_count bigint").repartition(5)
        S.write_manifest(df, str(tmp_path / "m"), ["json", "tsv", "toml"])
        want = [r[4] for r in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3], r[4]))]
        assert len(list((tmp_path / "m/json").glob("part-*"))) > 1
        lines = [r.value for r in S.read_in_order(spark, str(tmp_path / "m/json")).orderBy("pos").collect()]
        assert [json.loads(x)["Path"] for x in lines] == want
        assert [s["path"] for s in tomllib.loads("\n".join(r.value for r in S.read_in_order(spark, str(tmp_path / "m/toml")).orderBy("pos").collect()))["snapshots"]] == want
        assert [x.split("\t")[7] for p in sorted((tmp_path / "m/tsv").glob("*.csv")) for x in p.read_text().splitlines()[1:]] == want
        assert [r.snapshot for r in M.ordered_snapshots(df.fillna("")).collect()] == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_large_files_in_steps(spark, tmp_path, monkeypatch):
    """Files over the bound: whole and cut ones, several members, bad checksums, a missing member, a text that is no archive, and a file that is gone."""
    monkeypatch.setattr(S, "STEP", 64)
    whole = gzip.compress(bytes(range(256)) * 40)
    bad = bytearray(whole)
    bad[-6] ^= 1
    names = {"one.gz": whole, "two.gz": whole + whole, "cut.gz": whole[:-9], "bad.gz": bytes(bad), "tail.gz": whole + b"x", "none.gz": b"", "text.gz": b"no archive at all"}
    for n, v in names.items():
        (tmp_path / n).write_bytes(v)
    files = S.file_states(spark, str(tmp_path)).withColumnRenamed("bytes", "length")
    got = {r.path.rsplit("/", 1)[1]: r.ok for r in S.gzip_intact(files).collect()}
    assert got == {"one.gz": True, "two.gz": True, "cut.gz": False, "bad.gz": False, "tail.gz": False, "none.gz": False, "text.gz": False}
    z = tmp_path / "z"
    z.mkdir()
    with zipfile.ZipFile(z / "a.zip", "w") as f:
        f.writestr("m.xml", "x" * 5000)
    data = bytearray((z / "a.zip").read_bytes())
    data[100] ^= 1
    (z / "crc.zip").write_bytes(bytes(data))
    (z / "cut.zip").write_bytes(bytes(data)[:-30])
    states = S.file_states(spark, str(z)).withColumnRenamed("bytes", "length")
    assert {r.path.rsplit("/", 1)[1]: r.ok for r in S.zip_member_ok(states, "m.xml").collect()} == {"a.zip": True, "crc.zip": False, "cut.zip": False}
    assert not any(r.ok for r in S.zip_member_ok(states, "other.xml").collect())
    gone = states.limit(1).withColumn("path", F.lit(f"file:{tmp_path}/gone"))
    assert [r.ok for r in S.gzip_intact(gone).collect()] == [False]


def test_listing_by_levels(spark, tmp_path):
    """Deep and wide folders, hidden names, empty folders and files, names with blanks; a file and a pattern as root."""
    want = {}
    for k, n in enumerate(["a/b/c/d/e/f.txt", "a/.hidden/g", "_h", "a/b/sp ace%20é", "z/empty", *(f"w{k}/x" for k in range(20))]):
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_bytes(b"x" * k)
        want[n] = k
    (tmp_path / "no files/here").mkdir(parents=True)
    got = {r.path.split(f"{tmp_path}/")[1]: r.bytes for r in S.file_states(spark, str(tmp_path), deal=3).collect()}
    assert got == want | {"z/empty": 4}
    assert {r.bytes for r in S.file_states(spark, str(tmp_path / "w*")).collect()} == set(range(5, 25)) and S.file_states(spark, str(tmp_path / "_h")).first().bytes == 2
    assert S.file_states(spark, str(tmp_path / "nothing")).count() == 0


def test_sidecar_plan(spark):
    """A plan written into a sidecar and decoded from it breaks no rule; a changed leaf does."""
    edges = edge_rows(spark, [(o, "S", f"T{k:03d}") for o in ("9606", "10090") for k in range(150)])
    plan = E.plan_edge_batches(edges).select("organism", "batch", "targets", "expected_edges", "url").collect()
    plan.sort(key=lambda r: (r.organism != "9606", r.batch))
    leaves = [{"organism": r.organism, "targets": r.targets, "expected_edges": r.expected_edges, "url": r.url} for r in plan]
    for change, want in ((0, set()), (1, {"counts", "total"})):
        leaves[0]["expected_edges"] += change
        text = json.dumps({"schema": "full-evidence-v1", "leaf_batches": leaves})
        meta = S.classify_sidecars(spark.createDataFrame([("f", text)], "file string, value string")).withColumn("query_id", F.lit(1))
        assert {r.rule for r in E.validate_batch_plan(E.sidecar_leaves(meta), edges, ["9606", "10090"]).collect()} == want


def test_stream_restart(spark, tmp_path):
    """A restart goes on; only touched buckets are written anew, vanished keys leave, old versions and their buckets go."""
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    schema = "path string, k bigint, v int"
    there = [["a", "b", "c", "d", "e", "f"]] * 3 + [["a", "b", "d", "e", "f"]]
    batches = [[(p, 1, 1) for p in "abcdef"], [("a", 2, 5), ("b", 0, 9)], [], [("a", 3, 6)]]
    written_ = []
    for rows, keys in zip(batches, there, strict=True):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        q = upsert_stream(spark.readStream.schema(schema).parquet(src), out, cp, "path", ["k"], every=None, present=lambda keys=keys: spark.createDataFrame([(x,) for x in keys], "path string"), buckets=32, keep=2)
        q.awaitTermination()
        written_.append({p.name for p in (tmp_path / "out/buckets").glob("v*/bucket=*")} and sorted(str(p.relative_to(tmp_path / "out/buckets")) for p in (tmp_path / "out/buckets").glob("v*/bucket=*")))
    assert {tuple(r) for r in latest_version(spark, out, schema).collect()} == {("a", 3, 6), ("b", 1, 1), ("d", 1, 1), ("e", 1, 1), ("f", 1, 1)}
    assert len([x for x in written_[1] if x.startswith("v000000001/")]) <= 2 < len([x for x in written_[1] if x.startswith("v000000000/")])
    assert versions(spark, out) == [1, 2] and "c" not in {r.path for r in latest_version(spark, out, schema).collect()}
    assert len(written_[3]) <= 6 + 2


def test_stream_batch_again(spark, tmp_path):
    """A batch that runs again, as after a lost driver, gives the same version."""
    out, schema = str(tmp_path / "out"), "path string, k bigint"
    first, second = spark.createDataFrame([("a", 1), ("b", 1)], schema), spark.createDataFrame([("a", 2), (None, 1)], schema)
    for batch, k in ((first, 0), (second, 1), (second, 1)):
        merge_batch(spark, batch, k, out, "path", ["k"], buckets=4)
    assert {tuple(r) for r in latest_version(spark, out, schema).collect()} == {("a", 2), ("b", 1), (None, 1)}
    merge_batch(spark, first.limit(0), 2, out, "path", ["k"], buckets=4)
    assert latest_version(spark, out, schema).count() == 3


@pytest.mark.parametrize("policy,want", [("strict", ["reuse", "acquire", "acquire", "acquire"]), ("manifest_first", ["reuse_manifest", "rebuild_hash", "rebuild_hash", "acquire"]), ("adopting", ["reuse_manifest", "acquire", "rebuild_hash", "acquire"]), ("intact", ["rebuild_hash", "rebuild_hash", "rebuild_hash", "acquire"])])
def test_policies(spark, policy, want):
    s = "path string, bytes bigint, sha256 string"
    exp = spark.createDataFrame([(p,) for p in "abcd"], "path string")
    rec = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], s)
    got = R.plan_fetch(exp, rec, spark.createDataFrame([("a", 1, "x"), ("b", 3, "y"), ("c", 4, "z")], s), policy)
    assert [r.decision for r in got.orderBy("path").collect()] == want
