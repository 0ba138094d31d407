"""Archives, mixing, search and the pipeline; and the SQL of those queries that have it."""

import io
import math
import random
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from ledgerloom.llm import jaccard, linededup, mixing, queries, topk, warc
from ledgerloom.session import write_once
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    _, problems = compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLE_SQL[name])
    assert not problems


def test_all_are_registered():
    names = set(spark_entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}


@pytest.mark.parametrize("name", ["op2_line_dedup", "op3_fingerprints"])
def test_native_plans_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def zip64(members):
    """A ZIP file all of whose sizes and places stand in ZIP64 fields, with a comment at its end."""
    out, central = b"leading bytes", b""
    for name, data in members:
        at = len(out)
        out += struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
        extra = struct.pack("<HHB", 0x9999, 1, 7) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        central += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    begin = len(out)
    end = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, len(members), len(members), len(central), begin)
    locator = struct.pack("<IIQI", 0x07064B50, 0, begin + len(central), 1)
    return out + central + end + locator + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 3) + b"PK\x05"


def test_directories():
    members = [(b"a.txt", b"first"), (b"dir/b.bin", b"\x00" * 70_000)]
    made = zip64(members)
    assert [(m.name.encode(), made[m.start : m.start + m.size]) for m in warc.directory(io.BytesIO(made), len(made))] == members
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as file:
        file.writestr("x", b"stored")
        file.writestr("y", b"packed" * 100, zipfile.ZIP_DEFLATED)
        file.comment = b"a comment"
    found = warc.directory(plain, len(plain.getvalue()))
    assert [(m.name, plain.getvalue()[m.start : m.start + m.size]) for m in found] == [("x", b"stored")]
    with pytest.raises(ValueError):
        warc.directory(io.BytesIO(b"no archive"), 10)


def test_archives_are_plain_zip_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    monkeypatch.setattr(warc, "RANGE_BYTES", 3_000)
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    manifest = warc.write_archives(pages, str(tmp_path))
    names = [r.archive for r in manifest.collect()]
    assert len(names) > 1
    with zipfile.ZipFile(tmp_path / names[0]) as file:
        assert file.testzip() is None and file.namelist() == [warc.DATA, warc.INDEX]
    got = {r.page_id: (bytes(r.payload) if r.payload is not None else r.refers_to) for r in warc.read_archives(manifest, str(tmp_path)).collect()}
    for r in pages.collect():
        payload = got[r.page_id] if isinstance(got[r.page_id], bytes) else got[got[r.page_id]]
        assert payload == r.html.encode()


def test_schedule_keeps_within_a_block():
    rnd = random.Random(1)
    for n in (1, 2, 5, 20):
        blocks, weights = [rnd.randint(1, 300) for _ in range(n)], [rnd.random() + 0.01 for _ in range(n)]
        plan = mixing.schedule(blocks, weights)
        slot_of = {}
        for i, own in enumerate(plan):
            for k in range(blocks[i]):
                p = [x for x in own if x.block <= k][-1]
                nth = k - p.block
                slot = p.base + nth // len(p.offsets) * p.period + p.offsets[nth % len(p.offsets)]
                assert slot not in slot_of
                slot_of[slot] = i
        assert sorted(slot_of) == list(range(sum(blocks)))
        bases = sorted({p.base for own in plan for p in own}) + [sum(blocks)]
        for a, b in zip(bases, bases[1:]):
            share = {i: len(p.offsets) / p.period for i, own in enumerate(plan) for p in own if p.base == a}
            so_far = dict.fromkeys(share, 0)
            for t in range(a, b):
                so_far[slot_of[t]] += 1
                assert all(abs(so_far[i] - share[i] * (t - a + 1)) < 1 for i in share)


def test_schedule_keeps_to_the_weights_given():
    """Long phases, and weights that no short period can express."""
    for blocks, weights in (
        ([30_000, 30_000, 30_000], [1.0, math.pi, 0.7]),
        ([60_000, 20, 40_000], [1.0, 1e-4, 0.618]),
        ([20_000] * 4 + [5] * 8, [1 / 3, 0.1, 0.77, 0.2, *[1e-5] * 8]),
    ):
        plan = mixing.schedule(blocks, weights)
        bases = sorted({p.base for own in plan for p in own}) + [sum(blocks)]
        order = np.full(sum(blocks), -1)
        for i, own in enumerate(plan):
            slots = np.concatenate([np.asarray(p.offsets.known) + p.base for p in own])
            assert (np.diff(slots) > 0).all() and len(slots) == blocks[i]
            order[slots] = i
        assert (order >= 0).all()
        left = np.array(blocks)
        for a, b in zip(bases, bases[1:]):
            total = sum(w for w, n in zip(weights, left) if n)
            for i in np.flatnonzero(left):
                so_far = np.cumsum(order[a:b] == i)
                assert np.abs(so_far - weights[i] / total * np.arange(1, b - a + 1)).max() < 1 + 1e-6
            left = left - np.bincount(order[a:b], minlength=len(blocks))
            assert b == sum(blocks) or (left[order[b - 1]] == 0)


def test_mix_joins_slots_by_shuffle_too(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source")
    expected = sorted(mixing.mix(docs, block_rows=2).collect())
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(mixing.mix(docs, block_rows=2).collect()) == expected


def test_mix_places_each_row_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mixed = mixing.mix(docs, {"src0": 3.0, "src1": 1.0}, block_rows=2).orderBy("mix_position").collect()
    assert sorted(r.doc_id for r in mixed) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert len({r.mix_position for r in mixed}) == len(mixed)
    by_block = {}
    for r in mixed:
        by_block.setdefault((r.source, r.mix_block), []).append(r.mix_slot)
    assert all(len(v) <= 2 and len(set(v)) == 1 for v in by_block.values())
    with pytest.raises(ValueError):
        mixing.mix(docs, {"src0": 0.0})


def test_search_prunes_and_stays_exact(rows, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "GROUP", 3)
    monkeypatch.setattr(topk, "SAMPLE_ROWS", 10)
    monkeypatch.setattr(topk, "PIVOTS", 3)
    rnd = random.Random(2)
    vectors = [(k, [rnd.choice([-2, -1, 0, 1, 2]) / 4 + rnd.choice([0, 0.001]) for _ in range(5)]) for k in range(300)]
    whole = {k: [int((256 * x) // 1) for x in v] for k, v in vectors}
    expected = []
    for q in range(0, 300, 50):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[k])), k) for k in whole if k != q)[:5]
        expected += [(q, r + 1, k, -s) for r, (s, k) in enumerate(scores)]
    found = topk.search(rows("vec_id long, embedding array<double>", vectors), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == expected


def test_pipeline_stages(spark):
    """Each stage against what it should do with its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], FOLDER)
        assert out.columns == docs.columns, name
        kept.append(spark.createDataFrame(out.collect(), docs.schema))
    clean, lines, one, mixed = kept[1:]
    expected = {r.doc_id: r.text for r in linededup.drop_later_copies(clean).collect()}
    got = {r.doc_id: r for r in lines.collect()}
    assert all(got[i].text == t and got[i].n_chars == len(t) if i in got else not t.strip() for i, t in expected.items())
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in jaccard.join(lines).where("doc_id = component_id").collect()}
    order = [r.doc_id for r in mixing.mix(one).orderBy("mix_position").collect()]
    assert [r.doc_id for r in mixed.collect()] == order
    last = {r.doc_id: r.decoded for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert last == {r.doc_id: r.text for r in mixed.collect()}


def test_the_order_of_the_mix_outlasts_its_files(spark):
    """Many files of unlike size, read in an order of Spark's own."""
    settings = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
        expected = [r.doc_id for r in mixing.mix(docs).orderBy("mix_position").collect()]
        written = write_once(corpus_pipeline.mix_sources(spark, docs, FOLDER), "mixed")
        assert len(written.inputFiles()) > 10
        got = corpus_pipeline.encode(spark, written, FOLDER).collect()
        assert [r.mix_position for r in sorted(got, key=lambda r: r.mix_position)] == list(range(len(expected)))
        assert [r.doc_id for r in sorted(got, key=lambda r: r.mix_position)] == expected
        last = corpus_pipeline.run(spark, FOLDER).collect()
        assert sorted(r.mix_position for r in last) == list(range(len(last)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    names = [f"part-{n:05d}-u-c{c:03d}.snappy.parquet" for n in (9, 99_999, 100_000) for c in (0, 1, 1000)]
    assert sorted(sorted(names), key=corpus_pipeline._turn) == names


@pytest.mark.parametrize("bucket", [10_000, 40])
def test_every_row_has_a_place_whatever_the_buckets(rows, monkeypatch, bucket):
    """Several windows for each source: blocks are full, and no row is lost."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    sizes = {"a": 700, "b": 300, "c": 64, None: 5}
    docs = rows("doc_id long, source string", [(1000 * n + k, s) for n, (s, size) in enumerate(sizes.items()) for k in range(size)])
    found = mixing.mix(docs.repartition(3)).collect()
    assert len(found) == sum(sizes.values()) == len({r.mix_position for r in found})
    for s, size in sizes.items():
        blocks = sorted(r.mix_block for r in found if r.source == s)
        assert blocks == [k // 64 for k in range(size)]
    with_places = mixing.mix(docs, block_rows=10)
    assert with_places.select("mix_position").distinct().count() == sum(sizes.values())


@pytest.mark.parametrize("weights", [None, {"s0": 5.0, "s1": 3.0, "s77": 0.5}])
def test_tail_of_sources(rows, weights):
    """More sources than are scheduled: each row has one place, and a small source is spread evenly over the tail."""
    rnd = random.Random(4)
    sizes = {f"s{n}": (900 if n < 3 else rnd.randint(1, 12)) for n in range(300)} | {None: 7}
    docs = rows("doc_id long, source string, extra int", [(10_000 * n + k, s, n) for n, (s, size) in enumerate(sizes.items()) for k in range(size)])
    found = mixing.mix(docs.repartition(4), weights, most=4, block_rows=8).collect()
    assert sorted((r.doc_id, r.source) for r in found) == sorted((r.doc_id, r.source) for r in docs.collect())
    assert len({r.mix_position for r in found}) == len(found)
    tail = sorted((r for r in found if r.source not in ("s0", "s1", "s2")), key=lambda r: r.mix_position)
    assert [r.mix_block for r in tail] == [k // 8 for k in range(len(tail))]
    for s in ("s10", "s77", None):
        places = [k for k, r in enumerate(tail) if r.source == s]
        for nth, place in enumerate(places):
            assert -0.2 < place * len(places) / len(tail) - nth < 1.2  # of its rows so far, less than one off


def test_blocks_grow_with_the_table(rows, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCKS", 5)
    docs = rows("doc_id long, source string", [(k, "ab"[k % 2]) for k in range(1000)])
    found = mixing.mix(docs).collect()
    assert len({r.mix_position for r in found}) == 1000 and max(r.mix_slot for r in found) < 8
