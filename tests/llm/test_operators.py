"""Corpus operators on a small table with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""

import hashlib
import os
import pickle
import re
import uuid
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyarrow.parquet import ParquetFile
from pyspark.sql import functions as F

import corpus_pipeline
from candlewick.llm import (
    chunking, common, fingerprints, mixing, neighbours, packing, quality, scoring, simhash, suffixes, tokenfile,
)
from candlewick.llm.queries import QUERIES, SQL
from candlewick.session import shared_dir
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, t int, size long, packed string, place long"
PASSAGE = " ".join(f"shared{i}" for i in range(60))


def rows():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 500, n)) for n in (1, 2, 3, 40, 80, 200, 30, 30)]
    texts += [None, "", " \n\t ", "a", "ab " * 900, PASSAGE, f"{texts[3]} {PASSAGE} é{texts[4]}", texts[5], texts[5] + " x"]
    out = [(i * 3, x, "en", f"s{i % 3}" if i % 4 else None, len(x or "")) for i, x in enumerate(texts)]
    out += [out[5], (None, texts[6], None, "s1", 5), (6, "another text of the same id", "en", "s0", 1)]
    return [(*x, 1, 2, "p", 3) for x in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def test_mix_meets_targets(docs, empty):
    out = mixing.mixed_shares(docs).collect()
    assert len(out) == len(rows()) and mixing.mixed_shares(empty).count() == 0
    by = {}
    for x in out:
        assert 0 <= x.taken <= 3 * x["size"] and x.target <= 3 * x.source_size
        by.setdefault(x.source, [x.target, 0])[1] += x.taken
    assert all(abs(target - taken) <= 1 for target, taken in by.values())
    mix = mixing.mixed_documents(docs)
    assert mix.columns == docs.columns and mix.count() > 0


def test_each_row_of_the_mix_has_its_own_share(spark, monkeypatch):
    """Rows without an id, of one id and size, and equal in all columns: words taken meet each source's target."""
    monkeypatch.setattr(mixing, "COPIES", 3)
    text = lambda i, n: " ".join(f"t{i}w{j}" for j in range(n))
    rows = [(None, text(i, 10), "a", "x") for i in range(40)] + [(5, text(i, 7), "b", "x") for i in range(30)]
    rows += [(None, text(0, 9), "c", "x")] * 25 + [(6, text(1, 9), "c", lang) for lang in "xyz"] + [(7, None, "c", "x"), (8, "", None, "x")]
    docs = spark.createDataFrame([(*x, 1, "k", 2) for x in rows], "doc_id long, text string, source string, lang string, n long, key string, size int")
    shares = mixing.mixed_shares(docs).collect()
    assert len(shares) == len(rows)
    target, size = {x.source: x.target for x in shares}, {x.source: x.source_size for x in shares}
    for source in target:
        assert abs(sum(x.taken for x in shares if x.source == source) - target[source]) <= 1
        own = [x for x in shares if x.source == source and x.taken % max(x["size"], 1)]
        assert len(own) <= 1  # only one document of a source is cut
        assert all(x.taken <= 3 * x["size"] for x in shares)
    mix = mixing.mixed_documents(docs)
    words_taken = Counter()
    for x in mix.collect():
        words_taken[x.source] += len(words(x.text))
    assert mix.columns == docs.columns and all(abs(words_taken[s] - target[s]) <= 1 for s in target)
    assert size == {"a": 400, "b": 210, "c": 252, None: 0}
    assert mix.where("source = 'c' and doc_id = 6").select("lang").distinct().count() >= 1


def test_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(2)
    data = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((400, 8)))]
    data += [(1000, data[0][1]), (1001, None), (1002, [0.0] * 8), (1003, [float("nan")] * 8), (1004, [None] * 8), (1005, [1.0])]
    data += [(7, data[3][1]), (40, data[9][1]), (None, data[5][1]), (None, data[6][1]), (3, [1e200] * 9), (2020, [-1e200] * 9)]
    frame = spark.createDataFrame([(*x, 1, "b", 2, 3) for x in data], "vec_id long, embedding array<double>, dim int, band string, v int, row int")
    vectors = neighbours.clean_vectors(frame)
    got = neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), 5, block_rows=100).collect()
    good = [(i, np.array(v)) for i, v in data if v and None not in v and np.isfinite(v).all() and any(v)]
    hit, count, places = 0, 0, {}
    for x in got:
        places.setdefault((x.query_id, x.query), []).append((x.rank, x.vec_id))
    for n, (i, q) in enumerate(good):
        if i is None or i % 20:
            continue
        with np.errstate(over="ignore"):
            want = sorted((-(v * q).sum(), j is None, j or 0) for m, (j, v) in enumerate(good) if m != n and len(v) == len(q))[:5]
        mine = [sorted(v) for (k, _), v in places.items() if k == i]
        assert [r for r, _ in mine[0]] == list(range(1, len(want) + 1))
        hit += max(len({j or 0 for _, _, j in want} & {j or 0 for _, j in some}) for some in mine)
        count += len({j for _, _, j in want})
    assert hit >= 0.95 * count and len(places) == sum(i is not None and i % 20 == 0 for i, _ in good)
    assert neighbours.nearest(*[neighbours.clean_vectors(frame.where("false"))] * 2).count() == 0


def test_windows_count_collisions():
    """Ranks inside the windows are the values inside them, and as few are verified as asked for."""
    rng = np.random.default_rng(5)
    data = rng.standard_normal((3000, 16))
    block = neighbours.Block(np.arange(3000), np.arange(3000), data, 50_000, 1 / 50_000)
    query = data[:3] / block.scale
    centres = (query * (block.longest / np.sqrt((query * query).sum(1)))[:, None]) @ block.directions[:-1]
    low, size = block.windows(centres, 9)
    values = np.empty(block.sorted.shape)
    np.put_along_axis(values, np.argsort(block.rank, 1), block.sorted, 1)
    for i in range(3):
        want = (np.abs(values - centres[i][:, None]) <= neighbours.WIDTHS[9] * block.longest).sum(0)
        assert (block.collisions(low[i], size[i]) == want).all()
    assert {len(at) for at in block.candidates(query, 240)} == {240}
    assert neighbours.projections(0) == neighbours.projections(1024) < neighbours.projections(1 << 20) < neighbours.projections(1 << 40) == 255


@pytest.mark.skipif(not os.path.isdir("/root/testdata/check_s/embeddings.parquet"), reason="needs the larger table")
def test_neighbours_of_a_larger_table(spark):
    """Recall where only a part of the vectors is verified."""
    frame = spark.read.parquet("/root/testdata/check_s/embeddings.parquet")
    vectors = neighbours.clean_vectors(frame)
    got = neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 200 == 0)).toPandas()
    rows = vectors.select("vec_id", "v").toPandas()
    data, ids = np.stack(rows["v"].to_numpy()), rows["vec_id"].to_numpy()
    hit = 0
    for q, mine in got.groupby("query_id"):
        scores = (data * data[ids == q][0]).sum(1)
        scores[ids == q] = -np.inf
        assert len(mine) == 20
        hit += len(set(ids[np.argsort(-scores)[:20]]) & set(mine["vec_id"]))
    assert hit >= 0.95 * len(got) > 0


@pytest.mark.parametrize("lengths", ["one long", "lognormal"])
def test_neighbours_of_unequal_length(spark, lengths):
    rng = np.random.default_rng(3)
    data = rng.standard_normal((8192, 64))
    data /= np.sqrt((data * data).sum(1))[:, None]
    data *= rng.lognormal(0, 0.5, len(data))[:, None] if lengths == "lognormal" else 1
    data[5] *= 5 if lengths == "one long" else 1
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(data)), "embedding": list(data)}))
    vectors = neighbours.clean_vectors(frame)
    got = neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 80 == 0)).toPandas()
    hit = 0
    for q, mine in got.groupby("query_id"):
        scores = data @ data[q]
        scores[q] = -np.inf
        assert len(mine) == 20
        hit += len(set(np.argsort(-scores)[:20]) & set(mine["vec_id"]))
    assert len(got) == 20 * 103 and hit >= 0.9 * len(got)


def test_classifier_separates(spark, docs, empty):
    good = [(i, f"Plain words of text number {i} here.") for i in range(60)]
    bad = [(100 + i, f"BUY!! NOW!! {i}%%% ###") for i in range(60)]
    frame = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad] + [(None, 1), (7, None)], "doc_id long, quality int")
    model = quality.train(frame, labels)
    out = {x.doc_id: x.score for x in quality.scored(frame, model).collect()}
    assert all((out[i] >= 0.5) == (i < 100) for i, _ in good + bad)
    assert quality.scored(docs, model).count() == len(rows()) and quality.accepted(docs, model).columns == docs.columns
    assert quality.scored(empty, model).count() == 0
    unlearnt = quality.train(empty, labels)
    assert {x.score for x in quality.scored(docs, unlearnt).collect()} == {0.5}


def test_chunks_keep_the_first_copy(docs, empty):
    out = chunking.without_copied_chunks(docs).collect()
    assert len(out) == len(rows()) and chunking.without_copied_chunks(empty).count() == 0
    assert sum("shared30 shared31" in x.text for x in out) == 1
    assert all(len(x.text.encode()) == x.n_bytes - x.n_removed for x in out)


def test_every_later_chunk_goes(spark):
    rng = np.random.default_rng(4)
    base = [f"word{x}" for x in rng.integers(0, 5000, 400)]
    texts = [" ".join(f"new{i}" if i % 12 == k else w for i, w in enumerate(base)) for k in (12, 3, 7)]  # short runs
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    later, seen = Counter(), set()
    for i, text in enumerate(texts):
        raw = text.encode()
        ends = chunking.chunk_ends(np.frombuffer(raw, np.uint8))
        for a, b in zip([0, *ends], ends):
            later[i] += (b - a) * (raw[a:b] in seen)
            seen.add(raw[a:b])
    out = {x.doc_id: x.n_removed for x in chunking.without_copied_chunks(frame).collect()}
    assert out == {i: later[i] for i in out} and min(out[1], out[2]) > 0


def test_edited_fingerprints(docs, empty):
    out = fingerprints.edited_fingerprints(docs, 3).collect()
    ordered = sorted(rows(), key=lambda x: (x[0] is None, -(x[0] or 0), x[1] is not None, x[1] or ""))
    want = Counter()
    for x, following in zip(ordered, ordered[1:] + ordered[:1]):
        want[x[0], hashlib.sha256(fingerprints.edited(x[1] or "", following[1] or "").encode()).hexdigest()] += 1
    assert Counter((x.doc_id, x.edited_sha256) for x in out) == want
    assert fingerprints.edited_fingerprints(empty, 3).count() == 0
    marked = fingerprints.document_fingerprints(docs)
    values = sorted({x.fingerprint for x in marked.collect()})
    apart = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    for limit in (20_000, 2):
        groups = {x.fingerprint: x.near_group for x in fingerprints.near_groups(marked, 12, limit).collect()}
        assert groups == reached(values, lambda a, b: apart(a, b) <= 12)


def reached(values, near):
    """Each value's least partner over any number of steps."""
    least = {x: x for x in values}
    while True:
        new = {x: min(least[y] for y in values if near(x, y)) for x in values}
        if new == least:
            return least
        least = new


@pytest.mark.parametrize("limit", [20_000, 3])
def test_near_groups_are_whole(spark, limit):
    """Chains, clusters and pairs at exactly the radius and beyond, in either half of the bits."""
    rng = np.random.default_rng(8)
    number = lambda: int.from_bytes(rng.bytes(16), "big")
    some = [number() for _ in range(60)]
    for base in some[:12]:
        now = base
        for _ in range(6):  # chains with steps of two to five bits
            now ^= sum(1 << int(b) for b in rng.choice(128, rng.integers(2, 6), replace=False))
            some.append(now)
        some += [base ^ (1 << int(b)) for b in rng.choice(128, 8, replace=False)]
    values = sorted({f"{x:032x}" for x in some})
    frame = spark.createDataFrame([(x,) for x in values], "fingerprint string")
    groups = {x.fingerprint: x.near_group for x in fingerprints.near_groups(frame, 3, limit).collect()}
    assert groups == reached(values, lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count() <= 3) and len(set(groups.values())) < len(values)


@pytest.mark.parametrize("limit, piece", [(2000, 1 << 19), (1, 1 << 19), (2000, 64)])
def test_repeated_bytes(docs, empty, limit, piece):
    texts = [(x[1] or "").encode() for x in rows()]
    seen = Counter(b[k : k + 200] for b in texts for k in range(len(b) - 199))
    want = Counter()
    for x, b in zip(rows(), texts):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        want[x[0], len(b), int(gone.sum())] += 1
    spans = suffixes.repeated_spans(docs, limit).groupBy("doc_id", "t").agg(F.collect_set("span").alias("at"))
    found = {(x.doc_id, bytes(x.t)): x["at"] for x in spans.collect()}
    keyed = docs.select("doc_id", common.text_key(), "text").collect()
    got = Counter()
    for x in keyed:
        data = common.text_bytes(x.text)
        got[x.doc_id, len(data), suffixes.kept_bytes(data, np.array(found.get((x.doc_id, bytes(x.t)), []), np.int64))[1]] += 1
    assert got == want
    for b in texts:
        if len(b) >= 200:
            whole, parts = (suffixes.document_anchors(np.frombuffer(b, np.uint8), p) for p in (1 << 19, piece))
            assert all((a == c).all() for a, c in zip(whole, parts))
    assert suffixes.cleaned_documents(docs).columns == docs.columns
    assert suffixes.without_repeats(empty).count() == 0


def test_packing_is_gapless_and_tight(docs, empty):
    out = packing.packed_documents(docs, 64).collect()
    by = {}
    for x in out:
        by.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(x.length for x in out)
    assert len(by) <= total / 64 * 1.1 + 1 and packing.packed_documents(empty, 64).count() == 0


def test_near_duplicates(docs, empty):
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == len(rows()) and simhash.near_duplicates(empty).count() == 0

    def mark(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        terms = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in terms]
        return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))

    f = [mark(x[1]) for x in rows()]
    root = list(range(len(f)))
    for _ in f:
        root = [min(root[j] for j in range(len(f)) if (f[i] ^ f[j]).bit_count() <= 2) for i in range(len(f))]
    want = Counter((x[0], f[i], min(rows()[j][0] for j in range(len(f)) if root[j] == root[i] and rows()[j][0] is not None))
                   for i, x in enumerate(rows()))
    assert Counter((x.doc_id, x.f & common.MASK, x.component_id) for x in out) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))


@pytest.mark.parametrize("limit, rows", [(100_000, 1 << 17), (1, 1 << 17), (100_000, 1), (1, 1)])
def test_links_are_whole(spark, monkeypatch, limit, rows):
    """Groups split by further blocks, and searched a few at a time, lose no link."""
    rng = np.random.default_rng(6)
    some = [int(x) for x in rng.integers(0, 1 << 62, 80)]
    some += [x ^ (1 << int(b)) ^ (1 << int(c)) for x in some[:40] for b, c in rng.integers(0, 62, (4, 2))]
    monkeypatch.setattr(simhash, "SEARCH_ROWS", rows)
    frame = spark.createDataFrame([(x,) for x in sorted(set(some))], "f long")
    label = {x.u: x.v for x in simhash.components(simhash.links(frame, 2, limit)).collect()}
    want = reached(sorted(set(some)), lambda a, b: (a ^ b).bit_count() <= 2)
    assert {x: label.get(x, x) for x in want} == want


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 40).astype(np.uint64)
    values = np.unique(np.concatenate([base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 60, 30)]))
    values = values[np.argsort(simhash.gray_rank(values))]
    pairs = {(int(i), int(j)) for a, b in simhash.near_pairs(np.zeros(len(values), int), values, 2) for i, j in zip(a, b)}
    n = len(values)
    assert pairs == {(i, j) for i in range(n) for j in range(i + 1, n) if int(values[i] ^ values[j]).bit_count() <= 2}


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 32])
def test_bits_round_trip(bits, tmp_path):
    from pyarrow import fs

    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype("<u4")
    system, path = fs.LocalFileSystem(), str(tmp_path / "x.bin")
    with system.open_output_stream(path) as out:
        writer = tokenfile.TokenWriter(out, bits, 64)
        for i, part in enumerate(np.array_split(ids, 7)):
            writer.add(i if i else None, part)
        writer.close()
    with system.open_input_file(path) as source:
        reader = tokenfile.TokenReader(source)
        assert (reader.ids(0, 1000) == ids).all() and (reader.ids(130, 517) == ids[130:517]).all() and reader.nulls[0]


def test_token_files(spark, docs, empty, tmp_path):
    path = common.tokenizer_path("byte_bpe_50k.json")
    manifest = tokenfile.write_token_files(docs, f"file://{tmp_path}", path, "spaced", 0, 3)
    out = sorted(tokenfile.read_token_files(manifest, 3).collect(), key=lambda x: x.start)
    from tokenizers import Tokenizer

    encode, at, want = Tokenizer.from_file(path), 0, Counter()
    for x in rows():
        ids = np.array([*encode.encode(x[1] or "", add_special_tokens=False).ids, 0], "<u4")
        want[x[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((x.doc_id, x.n_tokens, x.ids_crc32) for x in out) == want
    for x in out:
        assert x.start == at
        at += x.n_tokens
    assert tokenfile.read_token_files(tokenfile.write_token_files(empty, f"file://{tmp_path}/e", path, "spaced", 0, 2), 2).count() == 0


@pytest.mark.parametrize("head", [10_000, 5, 0])
def test_scores(docs, empty, head):
    model, rare = scoring.train(docs, head_words=head)
    out = scoring.scored(docs, model, rare).collect()
    counts = Counter(w for x in rows() for w in [*words(x[1]), "end"])
    n, v = sum(counts.values()), len(counts)
    want = Counter((x[0], len(words(x[1])) + 1, round(sum(
        np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*words(x[1]), "end"]), 6)) for x in rows())
    assert Counter((x.doc_id, x.n_tokens, round(x.base_score, 6)) for x in out) == want
    assert all(x.score > x.base_score and x.n_known == x.n_tokens for x in out if x.n_tokens > 20)
    unlearnt, none = scoring.train(empty)
    assert {x.score for x in scoring.scored(docs, unlearnt, none).collect()} == {0.0}


@pytest.mark.parametrize("part_bytes", [1 << 23, 512])
def test_scores_do_not_depend_on_what_is_broadcast(docs, part_bytes):
    def scores(most_bytes):
        model, rare = scoring.train(docs, most_bytes=most_bytes, part_bytes=part_bytes)
        assert (model.data is None) == (most_bytes == 100) and model.segments >= (4 if part_bytes > 512 else 8)
        out = scoring.scored(docs, model, rare).collect()
        return Counter((x.doc_id, x.n_tokens, x.n_known, round(x.base_score, 6), round(x.score, 6)) for x in out)

    assert scores(100) == scores(scoring.FILTER_BYTES)


def test_scoring_writes_few_files_and_no_table_of_texts(spark, docs, monkeypatch):
    """Every file that an executor writes costs it memory, so partitions without much in them share one."""
    stored, mark, segments = common.stored, uuid.uuid4().hex, 32 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(scoring, "stored", lambda frame, label, **options: stored(frame, f"{mark}-{label}", **options))
    settings = {"spark.sql.shuffle.partitions": str(segments), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        out = scoring.scored(docs, *scoring.train(docs))
        assert out.rdd.getNumPartitions() <= segments // 8 and out.count() == docs.count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    tables = list(Path(shared_dir(spark), "llm").glob(f"{mark}-*"))
    assert sorted(x.name.rsplit("-", 1)[0] for x in tables) == [f"{mark}-lm-filter", f"{mark}-lm-parts"]
    for folder in tables:
        files = [ParquetFile(x).metadata for x in folder.glob("*.parquet")]
        assert len(files) <= segments // 8 and all(x.num_row_groups == x.num_rows for x in files)


def test_filter_is_mapped_not_copied(docs):
    """The workers of an executor share the filter's file; a broadcast would be a copy for each, and one in the JVM."""
    model, _ = scoring.train(docs)
    packed = pickle.dumps(model)
    assert model.data.any() and model.data.tobytes() not in packed
    copy = pickle.loads(packed)
    assert isinstance(copy.data.base, np.memmap) and (copy.data == model.data).all()


def test_mixing_query_matches_sql(spark):
    assert difference(QUERIES["op1_mix_sources"](spark, FOLDER), connect(FOLDER), SQL["op1_mix_sources"]) is None


def test_pipeline_stages(spark):
    docs = common.table(spark, FOLDER, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.stored(stage(spark, kept, FOLDER), "test-stage")
        assert kept.columns == docs.columns and kept.count() > 0
    assert {"sequence_id", "offset"} <= set(corpus_pipeline.run(spark, FOLDER).columns)


def colliding(spark):
    """Two texts without repeats whose 32-bit hashes, as Spark takes them, are equal: found among random texts."""
    word = lambda k: F.substring(F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"/{k}")), 256), 1, 40)
    texts = spark.range(400_000).select(F.concat_ws(" ", *map(word, range(7))).alias("text"))
    pair = texts.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("same")).where(F.size("same") > 1).first()
    return pair["same"][:2]


def test_rows_without_id_are_told_apart(spark):
    """Unlike texts without an id stay unlike, whatever 32-bit hash they have."""
    first, second = colliding(spark)
    docs = spark.createDataFrame([(None, first), (None, second), (1, "other words entirely, not much of them")], "doc_id long, text string")
    assert {x.text for x in simhash.one_of_each(docs).collect()} >= {first, second}
    assert {x.n_removed for x in suffixes.without_repeats(docs).collect()} == {0}
    assert {x.text for x in suffixes.cleaned_documents(docs).collect()} >= {first, second}
    assert {(x.n_repeated, x.n_removed) for x in chunking.without_copied_chunks(docs).collect()} == {(0, 0)}


@pytest.mark.parametrize("doc_id", [None, 5])
def test_copies_in_repeated_rows_go(spark, monkeypatch, doc_id):
    text = " ".join(f"word{i}" for i in range(60))
    monkeypatch.setattr(chunking, "COPIES", 2)
    docs = spark.createDataFrame([(doc_id, text)] * 5 + [(9, text + " more"), (3, "alone")], "doc_id long, text string")
    out = sorted(((x.doc_id or 0, x.n_bytes, x.n_repeated, x.n_removed, x.text) for x in chunking.without_copied_chunks(docs).collect()), key=repr)
    mine = [x for x in out if x[0] == (doc_id or 0)]
    assert len(out) == 7 and sorted(x[3] for x in mine) == [0] + [len(text)] * 4 and max(x[2] for x in out) <= len(text) + 5
    assert sum("word3 word4" in x[4] for x in out) == 1


@pytest.mark.parametrize("name, cut", [("byte_bpe_50k.json", "spaced"), ("word_bpe_49k.json", "dropped")])
def test_special_strings_are_the_tokenizers(name, cut):
    from tokenizers import Tokenizer

    path = common.tokenizer_path(name)
    plain, coder = Tokenizer.from_file(path), common.Encoder(path, cut)
    marks = ["<|endoftext|>", "<|startoftext|>"]
    texts = [x for m in marks for x in (m, f"a{m}b", f" {m} ", f"words {m}\n{m}{m} more", f"<|endof {m[1:]}", f"{m[:-1]}", f"É{m}é", "w " * 3000 + m)]
    for text in ["no marks here", *texts, "again without", ""]:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_members_reach_python_as_arrays(spark):
    """A list of structs would be a dict for each member, for all texts of an Arrow batch at once."""
    from candlewick.llm import suffixes

    docs = spark.createDataFrame([(1, "x" * 400)], "doc_id long, text string")
    members = spark.createDataFrame([], "gram long, doc_id long, t binary, place long, large boolean")
    plan = suffixes.contexts(docs, members)._jdf.queryExecution().analyzed()
    assert plan.children().apply(0).schema().simpleString().count("struct<") == 1
