"""The training-data operators against brute force, public libraries, round trips and held-out labels."""

import base64
import datetime
import hashlib
import itertools
import math
import random

import numpy as np
import pytest
import tiktoken

from klinark.llm import exact_topk, graph_ann, quality, toxicity
from klinark.llm.byte_bpe import Codec, decode, encode, read_ranks, round_trip
from klinark.llm.mixing import Target, find_exponent, mix
from klinark.llm.ngram_join import PrefixTree, alike, link_components, ngram_components, sketch
from klinark.llm.queries import ORACLES, QUERIES
from klinark.llm.sharding import jump_shard, shard_documents
from klinark.llm.token_scan import read_token_files, scan_documents, write_tokens
from klinark.llm.url_filter import domains_of, host_of, judge_captures
from klinark.llm.vocabulary import EOD, PATTERN, vocabulary_path
from tests.oracle import compare, connect

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 3), (4, "one", "en", "a", 3),
       (5, "one", "en", None, 3), (6, "One two", "en", "b", 7), (None, "one two three four five six", "en", "b", 9),
       (7, "one two three four five six", "en", "b", 9), (7, "one two three four five six", "en", "b", 9),
       (8, "word " * 60_000, "en", "b", 300_000), (9, "é ü x 你好 \x0b y", "fr", "c", 9)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None


# 1: n-gram Jaccard join ----------------------------------------------------------------------


def grams(text, size):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + size]) for k in range(len(words) - size + 1)}


def brute_components(rows, size, percent):
    sets = [grams(r[1], size) for r in rows]
    to = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            old, new = to[b], to[a]
            to = [new if t == old else t for t in to]
    least = {}
    for t, r in zip(to, rows):
        if r[0] is not None:
            least[t] = min(r[0], least.get(t, r[0]))
    return sorted(((r[0], len(s), least.get(t) if s else r[0]) for r, s, t in zip(rows, sets, to)), key=repr)


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (2, 50)])
def test_components_equal_brute_force(spark, size, percent):
    draw = random.Random(size)
    base = [[f"w{draw.randrange(400)}" for _ in range(draw.choice([8, 60, 200]))] for _ in range(12)]
    rows = list(ODD)
    for k in range(150):
        words = list(draw.choice(base))
        for _ in range(draw.choice([0, 1, 2, 5, 10])):
            words[draw.randrange(len(words))] = f"w{draw.randrange(400)}"
        rows.append((100 + k, " ".join(words), "en", "s", 1))
    docs = spark.createDataFrame(rows, DOCS).withColumnsRenamed({"lang": "cls", "source": "grp", "n_chars": "root"})
    got = sorted((tuple(r) for r in ngram_components(docs, size, percent).collect()), key=repr)
    assert got == brute_components(rows, size, percent)


def test_components_of_an_empty_table(spark, none):
    assert ngram_components(none).count() == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_keep_every_link_and_part_unlike_sets(percent):
    rng = np.random.default_rng(percent)
    sets, families = [], 40
    for family in range(families):  # sizes on both sides of the powers of two at which sketches double
        base = rng.integers(0, 1 << 63, int(rng.choice([1, 20, 64, 66, 127, 130, 510, 515, 1030])), dtype=np.uint64)
        for _ in range(4):
            kept = base[rng.random(len(base)) > rng.choice([0, 0.02, 0.05, 0.12])]
            more = rng.integers(0, 1 << 63, int(rng.integers(0, 1 + len(base) // 12)), dtype=np.uint64)
            sets.append(np.unique(np.concatenate((kept, more))) if len(kept) else np.unique(base))
    label = alike(np.array([len(s) for s in sets]), [sketch(s) for s in sets], percent)
    links = 0
    for a, b in itertools.combinations(range(len(sets)), 2):
        common = len(np.intersect1d(sets[a], sets[b]))
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            links += 1
            assert label[a] == label[b]
    assert links > 20
    assert len(set(label.tolist())) >= families // 2


@pytest.mark.parametrize("percent", [20, 40])
def test_sketches_more_than_one_doubling_apart_keep_their_link(percent):
    rng = np.random.default_rng(percent)
    large = rng.integers(0, 1 << 63, 64 * 100 // percent - 10, dtype=np.uint64)
    sets = [np.unique(large[:64]), np.unique(large), np.unique(rng.integers(0, 1 << 63, 64, dtype=np.uint64))]
    label = alike(np.array([len(s) for s in sets]), [sketch(s) for s in sets], percent)
    assert label[0] == label[1]


def test_tree_finds_every_linked_set():
    draw = np.random.default_rng(3)
    base = [np.unique(draw.integers(0, 2 ** 40, 120).astype(np.uint64)) for _ in range(5)]
    sets = []
    for k in range(60):
        own = base[k % 5].copy()
        own[draw.integers(0, len(own), k % 9)] = draw.integers(0, 2 ** 40, k % 9).astype(np.uint64)
        sets.append(np.unique(own))
    sets = list({s.tobytes(): s for s in sets}.values())
    sets.sort(key=lambda s: s.astype(">u8").tobytes())
    tree, every = PrefixTree(sets), np.arange(len(sets) + 1)
    for own in sets:
        linked = {k for k, s in enumerate(sets)
                  if 100 * len(np.intersect1d(own, s)) >= 90 * len(np.union1d(own, s))}
        assert set(tree.matches(own, every, 90).tolist()) == linked
    labels = link_components(sets, np.arange(len(sets)), 90)
    assert len(set(labels.tolist())) < len(sets)


# 2 and 5: classifiers ----------------------------------------------------------------------------


def accuracy(spark, name, label, folder="/root/testdata/sf0.01"):
    from pyspark.sql import functions as F
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen = QUERIES[name](spark, folder).join(labels, "doc_id").filter("held_out")
    row = seen.agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.avg(F.col(label).cast("double"))).first()
    return row[0], max(row[1], 1 - row[1])


def test_quality_beats_the_majority_on_held_out_rows(spark):
    right, majority = accuracy(spark, "op2_quality_classifier", "quality")
    assert right > 0.95 > majority


def test_toxicity_is_no_worse_than_the_majority_with_few_labels(spark):
    right, majority = accuracy(spark, "op5_toxicity", "toxic")
    assert right > majority - 0.03


def test_additive_model_learns_an_interaction():
    draw = np.random.default_rng(1)
    x = np.zeros((4000, len(quality.FEATURES)))
    x[:, :2] = draw.random((4000, 2))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_positive_unlabelled_learning_finds_unlabelled_toxic_rows():
    draw = np.random.default_rng(2)
    truth = draw.random(3000) < 0.2
    rows = [np.unique(np.append(draw.integers(5, 60, 10), draw.integers(0, 5, 2) if t else [])).astype(np.int64) for t in truth]
    confirmed = [r for r, t in zip(rows[:1500], truth[:1500]) if t]
    model = toxicity.fit(confirmed + rows[1500:], np.arange(len(confirmed) + 1500) < len(confirmed), np.arange(60), 0.2)
    score = np.array([model.intercept + model.weights[r].sum() for r in rows[1500:]])
    assert ((score > 0) == truth[1500:]).mean() > 0.95


def test_classifiers_on_odd_rows_and_without_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    for docs in (odd, none):
        for own in (labels, labels.limit(0)):
            model = quality.train(quality.features(docs), own)
            scored = quality.score_features(quality.features(docs), model).collect()
            assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
            toxic = toxicity.add_scores(docs, toxicity.train(docs, own), name="s").collect()
            assert len(toxic) == docs.count() and all(0 <= r.s <= 1 for r in toxic)


def test_rows_that_repeat_an_id_do_not_outweigh_the_toxicity_sample(spark, monkeypatch):
    rows = [(k, f"mild words {k}") for k in range(40)] + [(7, f"loud words {k}") for k in range(300)] + [(7, "loud")] * 50
    labels = spark.createDataFrame([(k, int(k % 4 == 3)) for k in range(40)], "doc_id long, toxic int")
    seen, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda r, t, *rest: seen.append(t.tolist()) or fit(r, t, *rest))
    toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert sorted(seen[0]) == [False] * 40 + [True] * 10


# 3 and 7: tokens ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    with open(vocabulary_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_equal_the_library(spark, folder, library, odd):
    def wanted(doc_id, text):
        ids = library.encode_ordinary(text or "")
        return (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    expected = sorted(wanted(r.doc_id, r.text) for r in docs.collect())
    assert sorted(tuple(r) for r in QUERIES["op7_byte_bpe"](spark, folder).collect()) == expected
    tokens = read_ranks(vocabulary_path())
    got = sorted((tuple(r) for r in round_trip(odd.withColumnRenamed("lang", "ids"), tokens, PATTERN).collect()), key=repr)
    assert got == sorted((wanted(r[0], r[1]) for r in ODD), key=repr)


def test_codec_on_strange_text(library):
    codec = Codec(read_ranks(vocabulary_path()), PATTERN)
    for text in ["\x00\x01 \x7f\xad  ▁ <unk> </s>", "aaaa" * 3000, "  \n\n  x", "🙂🙃 don't <|endoftext|>", "ÄÖÜ" * 50]:
        ids = codec.encode([text])[0]
        assert ids.tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_encode_keeps_columns_and_replaces_the_named_one(spark, none):
    tokens = read_ranks(vocabulary_path())
    docs = spark.createDataFrame([(1, "hello world", "x")], "doc_id long, text string, ids string")
    back = decode(encode(docs, tokens, PATTERN), tokens).first()
    assert bytes(back.decoded) == b"hello world" and back.doc_id == 1
    assert encode(none, tokens, PATTERN).count() == 0


def test_token_counts_equal_the_library(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r.doc_id: r.n_tokens for r in QUERIES["op3_token_counts"](spark, folder).collect()}
    assert got == {r.doc_id: len(library.encode_ordinary(r.text or "")) for r in docs}


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 100_000])
def test_documents_are_stitched_across_blocks(spark, block):
    lengths = [0, 5, 1, 0, 0, 30, 2, 12, 0]
    docs = spark.createDataFrame([(k, [7] * n) for k, n in enumerate(lengths)], "doc_id long, ids array<int>").coalesce(1)
    blocks = write_tokens(docs, 9, 2, block_tokens=block)
    found = scan_documents(blocks, 9, 2).orderBy("doc").collect()
    assert [(r.doc, r.key, r.n_tokens) for r in found] == [(k, k, n) for k, n in enumerate(lengths)]


def test_flat_files_with_an_unclosed_last_document(spark, tmp_path):
    for name, values in {"a.bin": [1, 9, 9, 2, 2, 9, 3, 3, 3], "b.bin": [9], "c.bin": [4, 4], "d.bin": []}.items():
        np.array(values, "<u4").tofile(tmp_path / name)
    blocks = read_token_files(spark, str(tmp_path), 4, block_tokens=2)
    found = scan_documents(blocks, 9, 4).collect()
    by_file = {}
    for r in sorted(found, key=lambda r: (r.file, r.doc)):
        by_file.setdefault(r.file, []).append(r.n_tokens)
    assert sorted(by_file.values()) == [[0], [1, 0, 2, 3], [2]]


def test_token_files_are_named_by_their_paths(spark, tmp_path):
    for name in "ab":
        np.array([1, 9], "<u4").tofile(tmp_path / f"{name}.bin")
    files = {r.file for r in read_token_files(spark, str(tmp_path), 4).collect()}
    assert {f.rsplit("/", 1)[1] for f in files} == {"a.bin", "b.bin"}


# 4: shards ------------------------------------------------------------------------------------------


def jump(key, shards):
    key, b, j = key % 2 ** 64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2 ** 64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_shards_equal_the_plain_loop(spark):
    keys = [0, 1, 2, 10, -1, -2 ** 63, 2 ** 63 - 1, *random.Random(5).sample(range(10 ** 12), 300)]
    from pyspark.sql import functions as F
    for shards in (1, 2, 16, 17, 100):
        rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump_shard(F.col("k"), shards).alias("s")).collect()
        assert {r.k: r.s for r in rows} == {k: jump(k, shards) for k in keys}


def test_slots_are_gapless_with_nulls_and_repeated_rows(spark, odd, none):
    many = odd.unionByName(odd).unionByName(odd.limit(5)).withColumnRenamed("lang", "shard").withColumnRenamed("source", "slot")
    rows = shard_documents(many, 3).collect()
    assert len(rows) == 2 * len(ODD) + 5
    for shard in range(3):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 3) for r in rows)
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (1, 2)} == {(1, 0)}
    assert shard_documents(none).count() == 0


# 6: URL filters --------------------------------------------------------------------------------------


def test_captures_are_judged_by_the_entries_of_their_day(spark):
    from pyspark.sql import functions as F
    day = lambda m, d: datetime.date(2024, m, d)
    entries = spark.createDataFrame(
        [("spam", "Bad.org", day(1, 10), "add"), ("spam", "bad.org", day(2, 1), "remove"), ("spam", "bad.org", day(3, 1), "add"),
         ("adult", "x.bad.org", day(1, 20), "add"), ("spam", "same.org", day(1, 1), "add"), ("spam", "same.org", day(1, 1), "remove"),
         ("spam", None, day(1, 1), "add"), (None, "y.org", day(1, 1), "add")], "list string, domain string, day date, action string")
    rows = [("http://bad.org/a", day(1, 9)), ("http://bad.org/a", day(1, 10)), ("https://u:p@X.bad.org.:80/?q", day(1, 25)),
            ("http://bad.org", day(2, 1)), ("http://a.b.bad.org", day(3, 5)), ("http://notbad.org", day(3, 5)),
            ("http://same.org", day(1, 2)), (None, day(1, 1)), ("no url", day(3, 5)), ("http://bad.org/a", None)]
    captures = spark.createDataFrame([(k, u, d, "old") for k, (u, d) in enumerate(rows)], "page_id long, url string, fetched date, lists string")
    got = {r.page_id: (r.blocked, r.lists) for r in judge_captures(captures, entries).collect()}
    assert {k: v[1] for k, v in got.items() if v[0]} == {1: ["spam"], 2: ["adult", "spam"], 4: ["spam"]}
    assert len(got) == len(rows)
    assert judge_captures(captures, entries.limit(0)).filter("blocked").count() == 0
    assert judge_captures(captures.limit(0), entries).count() == 0
    one = spark.range(1).select(domains_of(host_of(F.lit("http://a.b.co.uk/"))), domains_of(host_of(F.lit("http://localhost"))))
    assert [list(x) for x in one.first()] == [["a.b.co.uk", "b.co.uk", "co.uk"], ["localhost"]]


# 8: mixtures -------------------------------------------------------------------------------------------


def test_exponents_meet_their_targets(spark):
    tokens = [1000, 200, 50, 10]
    sources = spark.createDataFrame([(str(k), t) for k, t in enumerate(tokens)], "s string, tokens long")
    shares = np.array(tokens) / sum(tokens)
    a = find_exponent(sources, Target(repeats=4.0))
    assert abs(100 ** (1 - a) - 4) < 1e-3
    a = find_exponent(sources, Target(entropy=1.2))
    w = shares ** a / (shares ** a).sum()
    assert abs(-(w * np.log(w)).sum() - 1.2) < 1e-4
    assert find_exponent(sources, Target(entropy=9.0)) == 0 and find_exponent(sources, Target(entropy=0.0)) == 1
    assert find_exponent(sources, Target(repeats=1000.0)) == 0
    assert find_exponent(sources.limit(0), Target(repeats=2.0)) in (0.0, 1.0)


@pytest.mark.parametrize("budget", [None, 400, 3000])
def test_blocks_are_permutations_within_their_budget(spark, budget):
    draw = random.Random(8)
    rows = [(k, " ".join(["w"] * draw.randrange(9)), "en", draw.choice(["a"] * 6 + ["b", "b", None]), 1) for k in range(300)]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "_block")
    out = mix(docs, Target(repeats=3.0), budget).collect()
    tokens = {r[0]: len(r[1].split()) for r in rows}
    by_source = {}
    for k, _, _, s, _ in rows:
        by_source.setdefault(s, []).append(k)
    for s, ids in by_source.items():
        blocks = {}
        for r in out:
            if r.source == s:
                blocks.setdefault(r._block, []).append(r)
        assert sorted(blocks) == list(range(len(blocks)))
        for k in list(blocks)[:-1]:
            assert sorted(r.doc_id for r in blocks[k]) == sorted(ids)
        if budget is None:
            assert {r.doc_id for r in out if r.source == s} == set(ids)
        for own in blocks.values():
            keys = [hashlib.md5(f"mix|{r._block}|{r.doc_id}".encode()).hexdigest() for r in own]
            assert [r._order for r in own] == keys
    if budget:
        total = sum(tokens[r.doc_id] for r in out)
        assert budget - 9 * len(by_source) <= total <= budget


def test_mixture_of_odd_rows(spark, odd, none):
    out = mix(odd, Target(repeats=2.0)).collect()
    assert {r.doc_id for r in out} == {r[0] for r in ODD} and len(out) >= len(ODD)
    assert mix(none, Target(entropy=1.0)).count() == 0


# 9 and 10: searches ---------------------------------------------------------------------------------------


def vectors(spark, count=700, width=12):
    draw = np.random.default_rng(4)
    rows = [(k, draw.normal(size=width).round(2).tolist()) for k in range(count)]
    rows += [(1000 + k, rows[3][1]) for k in range(300)]  # one vector that many rows hold
    rows += [(2000, None), (2050, []), (2051, [math.nan] * width), (2052, [math.inf] * width), (2100, [0.0] * width),
             (2101, [None] * width), (None, rows[0][1]), (2150, rows[5][1][:5]), (7, rows[7][1])]
    return spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<double>, score int, x double"), rows


def test_exact_search_equals_brute_force(spark):
    frame, rows = vectors(spark)
    fine = {i: v for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v)}
    whole = {i: [math.floor(256 * c) for c in v] for i, v in fine.items()}
    expected = []
    for q in sorted(i for i in whole if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert sorted(tuple(r) for r in exact_topk.top_products(frame).collect()) == expected
    assert exact_topk.top_products(frame.limit(0)).count() == 0


def test_large_whole_numbers_stay_exact():
    q, x = np.array([[2 ** 40, 3]]), np.array([[2 ** 20, 1], [2 ** 20, 2]])
    assert exact_topk.products(q, x).tolist() == [[2 ** 60 + 3, 2 ** 60 + 6]]


def test_graph_search_finds_nine_of_ten(spark):
    frame, rows = vectors(spark)
    fine = {i: np.array(v + [0.0] * (12 - len(v))) for i, v in rows
            if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    got = {}
    for r in graph_ann.nearest_cosine(frame).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in fine if i % 50 == 0}
    hits = 0
    for q, found in got.items():
        cosine = {i: v @ fine[q] / math.sqrt(v @ v) / math.sqrt(fine[q] @ fine[q]) for i, v in fine.items() if i != q}
        found.sort()
        assert [k for k, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(cosine[i] - s) < 1e-12 for _, i, s in found)
        least = sorted(cosine.values(), reverse=True)[4]
        hits += sum(s >= least - 1e-12 for _, _, s in found)
    assert hits >= 0.9 * 5 * len(got)
    assert graph_ann.nearest_cosine(frame.limit(0)).count() == 0
    few = graph_ann.nearest_cosine(frame.filter("vec_id in (0, 1, 2)")).collect()
    assert len(few) == 2


def test_different_vectors_of_one_id_stay_candidates(spark, tmp_path):
    draw = np.random.default_rng(9)
    rows = [(k, draw.normal(size=6).tolist()) for k in range(120)]
    rows += [(i, draw.normal(size=6).tolist()) for i in (7, 50, 100) for _ in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame.write.parquet(str(tmp_path / "t"))
    source = connect(str(tmp_path))
    source.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/t/*.parquet')")
    assert compare(exact_topk.top_products(frame), source, ORACLES["op9_exact_topk"]) is None
    # equal rows are each a candidate and each a query, also more of them than results are asked for
    again = frame.union(frame.filter("vec_id % 3 < 2")).union(frame.filter("vec_id % 50 = 0"))
    for _ in range(3):
        again = again.union(frame.filter("vec_id in (3, 50, 77)"))
    again.write.parquet(str(tmp_path / "again"))
    source.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/again/*.parquet')")
    assert compare(exact_topk.top_products(again), source, ORACLES["op9_exact_topk"]) is None
    held = [(r.vec_id, np.array(r.embedding) / np.linalg.norm(r.embedding)) for r in again.collect()]
    found = {}
    for r in graph_ann.nearest_cosine(again).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in (0, 50, 100):
        wanted = sorted(((float(a @ b), -j) for i, a in held if i == q for j, b in held if j != q), reverse=True)[:5]
        assert [-v for _, v, _ in sorted(found[q])] == [v for _, v in wanted]
        assert np.allclose([s for _, _, s in sorted(found[q])], [s for s, _ in wanted])
    best = {}
    for r in graph_ann.nearest_cosine(frame).collect():
        best.setdefault(r.query_id, []).append(r.score)
    unit = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows]
    for q in (0, 50, 100):
        cosine = sorted((float(a @ b) for i, a in unit if i == q for j, b in unit if j != q), reverse=True)[:5]
        assert np.allclose(sorted(best[q], reverse=True), cosine)
