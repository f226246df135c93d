"""Result store, master table and archives."""

import io
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from sitewise.sinks.store import MASTER, ResultStore, master_table, write_master
from sitewise.sources import archives as A

ROWS = "gene string, site int, v string"


def test_store_against_a_dictionary(spark, tmp_path):
    rng = random.Random(1)
    store, held = ResultStore(spark, str(tmp_path / "s"), buckets=5), {}
    assert not store.exists()
    for step in range(5):
        genes = rng.sample([None, *(f"g{k}" for k in range(12))], 4)
        rows = [(g, p, f"{step}.{k}") for g in genes for p in rng.sample(range(50), 3) for k in range(2)]
        store.put(spark.createDataFrame(rows, ROWS))
        store.put(spark.createDataFrame(rows, ROWS))  # again: nothing changes
        for g in genes:
            held[g] = [r for r in rows if r[0] == g]
        assert sorted(map(tuple, store.read().select("gene", "site", "v").collect()), key=str) == sorted((r for rs in held.values() for r in rs), key=str)
    gene, position = next((g, rs[0][1]) for g, rs in held.items() if g)
    assert sorted(map(tuple, store.lookup(gene, position).select("gene", "site", "v").collect())) == sorted(r for r in held[gene] if r[1] == position)
    assert store.lookup("none").collect() == []
    plan = store.lookup(gene, position)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and f"EqualTo(gene,{gene})" in plan and f"EqualTo(site,{position})" in plan
    store.put(spark.createDataFrame([("new", 1, "x", 7)], f"{ROWS}, more int"))
    assert store.lookup("new").first()["more"] == 7 and store.lookup(gene).first()["more"] is None
    before = store.read().count()
    store.put(store.read().where("false"))
    assert store.read().count() == before


def test_master_table(spark, tmp_path):
    sites = spark.createDataFrame([("g", 1, True, [1, None, 2], 0.5, {"a": 1}), ("g", 2, None, [], None, None), ("h", 1, False, None, 1.0, {})],
                                  "gene string, msa_pos int, is_significant boolean, low_confidence_nodes array<int>, pvalue double, comments map<string,int>").withColumn("_pairs", F.lit("clash"))
    pairs = spark.createDataFrame([("g", 1, 1, 7, "A", 0.9), ("g", 1, 5, 8, "V", None), ("g", 1, 5, 8, "V", None), ("h", 1, 2, None, None, 0.1), ("x", 1, 1, 1, "A", 1.0), ("g", 2, None, 1, "A", 1.0)],
                                  "gene string, msa_pos int, pair_id int, node int, state string, posterior double")
    out = master_table(sites.drop("_pairs"), pairs)
    assert out.columns == [*MASTER, *[f"mrca_{k}_{c}" for k in range(1, 6) for c in ("node", "state", "posterior")]]
    rows = {(r["gene"], r["msa_pos"]): r for r in out.collect()}
    one = rows["g", "1"]
    assert (one["is_significant"], one["low_confidence_nodes"], one["pvalue"], one["comments"], one["tag"]) == ("True", "1,None,2", "0.5", '{"a":1}', "")
    assert (one["mrca_1_node"], one["mrca_1_state"], one["mrca_1_posterior"], one["mrca_5_node"], one["mrca_5_posterior"], one["mrca_3_state"]) == ("7", "A", "0.9", "8", "", "")
    assert (rows["g", "2"]["is_significant"], rows["g", "2"]["low_confidence_nodes"], rows["h", "1"]["is_significant"], rows["h", "1"]["mrca_2_posterior"]) == ("", "", "False", "0.1")
    assert len(rows) == 3
    empty = master_table(sites.drop("_pairs").where("false"), pairs.where("false"))
    write_master(empty, str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).columns == [*MASTER, "mrca_1_node", "mrca_1_state", "mrca_1_posterior"]


def packed(members, mode="w:gz"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as tar:
        for name, body in members:
            info = tarfile.TarInfo(name)
            if body is None:
                info.type = tarfile.DIRTYPE
            else:
                info.size = len(body)
            tar.addfile(info, io.BytesIO(body or b""))
    return out.getvalue()


def test_several_archives_and_a_broken_member(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    big = rng.randbytes(300_000)
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.tar.gz").write_bytes(packed([("d", None), ("d/x.txt", b"one\r\ntwo\n"), ("../up.txt", b"out"), ("e.txt", b""), ("x.bin", b"\x00\xff")]))
    (tmp_path / "sub" / "b.tar").write_bytes(packed([("big", big), ("x.txt", b"three")], "w"))
    (tmp_path / "notes.txt").write_text("no archive")
    rows = {(r.archive.rpartition("/")[2], r.member): bytes(r.content) for r in A.read_archives(spark, str(tmp_path)).collect()}
    assert rows == {("a.tar.gz", "d/x.txt"): b"one\r\ntwo\n", ("a.tar.gz", "../up.txt"): b"out", ("a.tar.gz", "e.txt"): b"", ("a.tar.gz", "x.bin"): b"\x00\xff", ("b.tar", "big"): big, ("b.tar", "x.txt"): b"three"}
    text = A.read_archives(spark, str(tmp_path), ".txt")
    assert sorted((r.member, r.line_no, r.line) for r in A.archive_lines(text).collect()) == [("../up.txt", 0, "out"), ("d/x.txt", 0, "one"), ("d/x.txt", 1, "two"), ("x.txt", 0, "three")]
    assert text.rdd.getNumPartitions() == 2
    for cut in (60, 100_000):
        broken = tmp_path / f"broken{cut}"
        broken.mkdir()
        (broken / "c.tar.gz").write_bytes(packed([("ok.txt", b"fine"), ("big", big)])[:cut])
        (broken / "d.tar.gz").write_bytes(packed([("ok2.txt", b"fine")]))
        with pytest.raises(Exception, match="c.tar.gz"):
            A.read_archives(spark, str(broken)).collect()
        got = {r.member for r in A.read_archives(spark, str(broken), broken="stop").collect()}
        assert got == ({"ok2.txt"} if cut == 60 else {"ok.txt", "ok2.txt"})
    reader = A.Reader({"path": str(tmp_path / "sub")})
    monkeypatch.setattr(A, "BATCH", 10)
    assert [b.num_rows for p in reader.partitions() for b in reader.read(p)] == [1, 1]


def test_written_archives(spark, tmp_path):
    rows = [(f"m{k}.fa", f">{k}\nACD".encode()) for k in range(20)] + [("none", None)]
    df = spark.createDataFrame(rows, "member string, content binary").withColumn("archive", F.lit("clash")).repartition(3, "member")
    A.write_archives(df, str(tmp_path / "out"))
    (tmp_path / "out" / "part-left.tar.gz").write_bytes(packed([("left", b"x")]))
    got = A.read_archives(spark, str(tmp_path / "out"))
    assert {r.member: bytes(r.content) for r in got.collect()} == {n: b or b"" for n, b in rows}
    (tmp_path / "nothing").mkdir()
    assert A.read_archives(spark, str(tmp_path / "nothing")).collect() == []
