"""The corpus operators against brute force, and on rows that are NULL, empty, long, tied or repeated."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from compare import difference, duck
from farestrata.llm import bpe, exact_dedup, mixing, quality, queries, rules, sharding, simhash, sql, suffix_dedup, toxicity, url_filters
from farestrata.llm.common import new_folder, table

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, size int, _mix_source int, fp int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, sources=None):
    """Documents with columns whose names clash with those used inside."""
    rows = [(i, t, None, (sources or ["a"] * len(texts))[n], 0, "x", 1, 2, 3) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


PHRASE = "a passage of more than fifty bytes that several documents share with others, é ü "
ODD = [
    (0, None), (1, ""), (2, "   \t\n"), (3, "same words here"), (4, "same words here"), (5, "Same Words Here"),
    (6, PHRASE + "one"), (7, "two " + PHRASE), (8, PHRASE * 3), (9, "x" * 3000), (10, "word " * 40_000),
    (11, "<|endoftext|> 's'LL 12345 naïve   \n\n tab\there <|endoftext|>"), (12, None), (13, "é" * 200 + PHRASE[10:70]),
    (14, "\x00\x01 nul"), (15, "of the and " * 30),
]


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# --- url rules ---------------------------------------------------------------------------------------------------


def test_url_parts():
    assert url_filters.split_url("HTTP://WWW.Exa.com:80/A/b?c#d") == ("www.exa.com:80", "/A/b")
    assert url_filters.split_url("http://é.net#x") == ("é.net", "")
    assert url_filters.split_url("no scheme") == url_filters.split_url(None) == ("", "")


@pytest.mark.parametrize("range_rows", [5, 100_000])
def test_url_rules_against_all_pairs(spark, range_rows):
    rng = random.Random(3)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "xa.com", "a-.com", "a.org", "org"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/y"]
    known = [(rng.choice(hosts), p, rng.choice(["allow", "block"])) for p in ["/", "/x", "/x/y", "", "/y"] for _ in range(3)]
    known = list({(h, p): (h, p, v) for h, p, v in known}.values())
    urls = [(i % 150, f"http://{rng.choice(hosts)}{rng.choice(paths)}" if i % 9 else None, 0) for i in range(200)]
    urls += [(1000 + i, "http://c.b.a.com/x/y", 0) for i in range(200)]
    frame = spark.createDataFrame(urls, "page_id bigint, url string, host int")
    found = url_filters.judge_urls(frame, spark.createDataFrame(known, "host string, path string, verdict string"), range_rows=range_rows)

    def expected(url):
        host, path = url_filters.split_url(url)
        fits = [r for r in known if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
        return host, path, best[0] + best[1] if best else None, best[2] if best else "allow"

    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.collect()) == Counter(
        (i, *expected(u)) for i, u, _ in urls)


def test_ranges_are_bounded_and_hosts_of_any_length_are_judged(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "MOST_RANGES", 3)
    urls = [(i, f"http://{'l' * (300 if i % 2 else 3)}.net/es/{i}") for i in range(400)] + [(None, "http://net/es/")] * 2
    known = spark.createDataFrame([("net", "/es/", "block")], "host string, path string, verdict string")
    found = url_filters.judge_urls(spark.createDataFrame(urls, "page_id bigint, url string"), known, range_rows=2).collect()
    assert len(found) == 402 and {(r.rule, r.verdict) for r in found} == {("net/es/", "block")}


def test_url_rules_must_be_whole(spark):
    frame = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    broken = spark.createDataFrame([(None, "/", "block")], "host string, path string, verdict string")
    with pytest.raises(Exception, match="not a rule"):
        url_filters.judge_urls(frame, broken).collect()


# --- sharding and mixing -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("bucket_rows", [7, 10_000])
def test_shards_match_the_mixture(spark, bucket_rows):
    names = ["hot"] * 200 + ["b"] * 64 + [None] * 37
    frame = docs(spark, [(i if i % 50 else None, f"t{i % 5}") for i in range(301)], names)
    out = sharding.shard(frame, 8, bucket_rows=bucket_rows).collect()
    sizes = Counter(r.shard for r in out)
    assert len(out) == 301 and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(8):
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sizes[shard]))
    source = dict(zip(range(301), names, strict=True))
    hot = Counter(r.shard for r in out if r.doc_id is not None and source[r.doc_id] == "hot")
    assert max(hot.values()) - min(hot.values()) <= 6


def test_rows_without_ids_spread_over_the_buckets(spark):
    """Half of the rows share one id: their shuffle keys differ, and shards hold equal counts."""
    frame = docs(spark, [(None if i % 2 else i, f"text {i}") for i in range(4_000)])
    rows_ = frame.select(F.col("doc_id").alias("id"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.length("text").alias("size"))
    keys = [r[0] for r in rows_.where("id IS NULL").select(sharding._shuffle_key(7)).collect()]
    buckets = Counter(key * 20 >> 60 for key in keys)
    assert len(set(keys)) == 2_000 and max(buckets.values()) < 2 * min(buckets.values())
    sizes = Counter(r.shard for r in sharding.shard(frame, 16, bucket_rows=200).collect())
    assert set(sizes.values()) == {250}


def test_buckets_do_not_change_shards(spark):
    frame = docs(spark, [(i, f"t{i}") for i in range(200)], ["a", "b", None, "a"] * 50)
    one, many = sharding.shard(frame, 16, bucket_rows=9), sharding.shard(frame, 16)
    assert rows(one) == rows(many)


def test_shards_of_odd_rows(odd, nothing):
    found = rows(sharding.shard(odd, 16))
    assert found[0].size == found[1].size == 1 and found[0].text_crc32 == 0
    assert found[9].text_crc32 == zlib.crc32(b"x" * 3000)
    assert sharding.shard(nothing, 16).count() == 0


def test_targets_stop_at_three_times(spark):
    frame = docs(spark, [(0, "w " * 10), (1, "w " * 1000), (2, "w " * 300), (3, "w"), (4, None)], ["a", "b", "c", None, "z"])
    found = rows(mixing.mixture(frame, (5, 2, 1)))
    # a 5, b 2, c 1, z 5, NULL 2; a, z and NULL stop at three times their size
    assert [found[i].target for i in (0, 4, 3)] == [30.0, 0.0, 3.0]
    assert found[1].target + found[2].target == pytest.approx(1311 - 33)
    assert found[1].target == pytest.approx(2 * found[2].target)
    assert all(r.taken <= 3 * r.size for r in found.values())


def test_mix_is_near_its_targets_and_documents_follow(spark):
    frame = docs(spark, [(i, "w " * (1 + i % 7)) for i in range(3000)], ["a", "b", "c"] * 1000)
    found = mixing.mixture(frame).collect()
    for source in range(3):
        own = [r for r in found if r.doc_id % 3 == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 7
    taken = Counter(r.doc_id for r in mixing.mixed_documents(frame).collect())
    assert all(taken[r.doc_id] * r.size == r.taken for r in found)


def test_mix_of_odd_rows(odd, nothing):
    found = rows(mixing.mixture(odd))
    assert len(found) == len(ODD) and found[0].size == 0 and sum(r.taken for r in found.values()) > 0
    assert mixing.mixture(nothing).count() == 0 and mixing.mixed_documents(odd).columns == odd.columns


def test_mix_divides_rows_that_share_an_id(spark):
    given = [(i, "w " * 5) for i in range(600)] + [(None, f"u{i} v w x y") for i in range(400)]
    given += [(7000, "s t u v w")] * 300 + [(i, "w") for i in range(8000, 8900)]
    frame = docs(spark, given, ["a"] * 1000 + ["b"] * 300 + ["c"] * 900)
    for seed in range(4):
        for weights in ((5, 2, 1), (3, 4, 5), (1, 7, 2)):
            found = mixing.mixture(frame, weights, seed).collect()
            for own in ([r for r in found if r.source_size == size] for size in (5000, 1500, 900)):
                assert abs(sum(r.taken for r in own) - own[0].target) <= 2.5
    mixed = mixing.mixed_documents(frame, (1, 7, 2), 3)
    assert mixed.columns == frame.columns
    words = {s: sum(len(WORD.findall(r.text)) for r in mixed.where(F.col("source") == s).collect()) for s in "abc"}
    assert words == {s: sum(r.taken for r in found if r.source_size == n) for s, n in (("a", 5000), ("b", 1500), ("c", 900))}


# --- learnt scores -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name, limit, least", [("op4_quality", 0.3, 0.9), ("op8_toxicity", 0.5, 0.75)])
def test_held_out_accuracy(spark, name, limit, least):
    folder = "/root/testdata/sf0.1"
    label = {"op4_quality": "quality", "op8_toxicity": "toxic"}[name]
    found = queries.queries()[name](spark, folder).join(table(spark, folder, "labels"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and (r.score >= limit) == r.predicted for r in found)
    for side in (0, 1):
        own = [r.predicted == side for r in found if r[label] == side]
        assert sum(own) / len(own) >= least


def test_features_are_counted_over_all_unlabelled_documents(spark, monkeypatch):
    """A word of few toxic documents that most unlabelled ones have too is no sign, however few of those are learnt from."""
    texts = [(i, ("badword " if i < 60 else "") + "usual words here") for i in range(600)]
    counted = []
    whole = toxicity.map_rows

    def noted(df, run, schema):
        counted.append((schema, df.count()))
        return whole(df, run, schema)

    monkeypatch.setattr(toxicity, "map_rows", noted)
    labels = spark.createDataFrame([(i, i < 60) for i in range(0, 600, 3)], "doc_id bigint, toxic boolean").select(
        "doc_id", toxicity.F.col("toxic").cast("int").alias("toxic"))
    learnt = toxicity.learn(docs(spark, texts), labels, most_open=50)
    n_open = docs(spark, texts).where(~toxicity.held_out("doc_id")).count()
    n_toxic = labels.where("toxic = 1").where(~toxicity.held_out("doc_id")).count()
    assert counted[0] == ("name string, open bigint, toxic bigint", n_open + n_toxic)
    assert set(learnt.at) == {"badword", "badw*", "badwo*"}
    assert toxicity.features_of(None) == set() and toxicity.features_of("a Naïve na") == {"naïve", "naïv*", "naïve*"}


@pytest.mark.parametrize("model", [quality, toxicity])
def test_learning_from_little(spark, odd, nothing, model):
    schema = "doc_id bigint, quality int, toxic int, text string"
    none = spark.createDataFrame([], schema)
    some = spark.createDataFrame([(i, i % 2, i % 2, "no input") for i in range(16)] + [(None, 1, 1, ""), (3, None, None, "")], schema)
    given, empty = (quality.counted(odd), quality.counted(nothing)) if model is quality else (odd, nothing)
    for labels in (none, some):
        learnt = model.learn(given, labels)
        found = model.score(given, learnt).collect()
        assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
        assert model.score(empty, learnt).count() == 0
    model.learn(empty, some)


def test_votes_are_those_of_all_cosines(spark):
    """Every labelled vector against every document, one by one; copies among the labelled ones make ties across the last place."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["Good", "words", "bad", "junk!!", "x9", "and", "more"], k=rng.randint(1, 30))) for _ in range(60)]
    texts = [(i, texts[i % 60] if i % 4 else "the same copy of all") for i in range(200)] + [(900, None), (901, ""), (902, "W" * 5000)]
    frame = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)], "doc_id bigint, quality int")
    known = quality.counted(frame)
    model = quality.learn(known, labels)
    total, seen = quality.document_frequencies(known)
    assert total == len(texts)

    def counts(text):
        words, out = WORD.findall(text or ""), Counter()
        for before, word in zip([None, *words], words):
            shape = re.sub(r"\d+", "9", re.sub(r"[a-zß-ÿ]+", "x", re.sub(r"[A-ZÀ-Þ]+", "X", word)).replace("X", "\0")).replace("\0", "X")
            out[zlib.crc32(word.encode()) % quality.WORD_TERMS] += 1
            out[quality.WORD_TERMS + zlib.crc32(shape.encode()) % quality.SHAPE_TERMS] += 1
            out[quality.REPEATS] += before == word
        return +out

    every = [counts(t) for _, t in texts]
    assert seen.tolist() == [sum(place in own for own in every) for place in range(quality.TERMS)]
    assert sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(200)) == len(model.vectors) > 3 * quality.NEAREST

    def by_force(own):
        vector = np.zeros(quality.TERMS)
        for place, n in own.items():
            vector[place] = np.log1p(n) * (np.log((1 + total) / (1 + seen[place])) + 1)
        vector = vector / (np.linalg.norm(vector) or 1) @ model.axes
        vector = vector / (np.linalg.norm(vector) or 1)
        near = sorted(((round(float(v @ vector), 4), n) for n, v in enumerate(model.vectors)), reverse=True)
        last = near[quality.NEAREST - 1][0]
        tied = [n for c, n in near if c == last]
        power = {n: c for c, n in near if c > last}
        power |= dict.fromkeys(tied, last * (quality.NEAREST - len(power)) / len(tied))
        power = {n: max(p, 0) * model.votes[n] for n, p in power.items()}
        whole = sum(power.values())
        return sum(p * model.labels[n] for n, p in power.items()) / whole if whole > 1e-6 else model.share

    found = {r.doc_id: r.score for r in quality.score(known, model).collect()}
    for (i, _), own in zip(texts, every, strict=True):
        assert abs(found[i] - by_force(own)) < 2e-3
    again = {r.doc_id: r.score for r in quality.score(known.repartition(7).sortWithinPartitions(F.desc("doc_id")), model).collect()}
    assert again == found
    # of documents that share a labelled id one is learnt from
    assert len(quality.learn(known.union(known).union(known), labels).vectors) == len(model.vectors)


def test_clean_documents_keep_their_columns(spark, odd):
    learnt = toxicity.Model(["word"], np.array([[9.0]]), np.array([-3.0]))
    kept = toxicity.keep_clean(odd, learnt)
    assert kept.columns == odd.columns and set(rows(kept)) == {i for i, _ in ODD} - {10}
    # a model without labels keeps everything
    assert toxicity.keep_clean(odd, toxicity.Model([], np.zeros((0, 0)), np.zeros(0))).count() == len(ODD)


def test_risk_is_never_driven_below_zero():
    rng = np.random.default_rng(0)
    toxic = np.c_[np.ones(50), rng.integers(0, 2, (50, 5))].astype(np.float32)
    open_ = np.c_[np.arange(500) % 10 == 0, rng.integers(0, 2, (500, 5))].astype(np.float32)
    weights, bias = toxicity.train_one(toxic, open_, 0.1, 1)
    assert (open_ @ weights + bias > 0).tolist() == (open_[:, 0] == 1).tolist()


# --- exact duplicates --------------------------------------------------------------------------------------------


def test_index_over_batches(spark, odd, nothing):
    folder = new_folder(spark, "test-index")
    index = exact_dedup.DigestIndex(spark, folder, buckets=3)
    found = rows(exact_dedup.judge(odd, index))
    assert [i for i, r in found.items() if not r.kept and r.group_size > 1] == [i for i in found if i in (0, 1, 3)]
    assert found[0].keep_id == 12 and found[0].group_size == 3
    assert found[0].text_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows(exact_dedup.judge(odd, index)) == found  # entered again after a failure
    index.close()
    with pytest.raises(ValueError, match="3 buckets"):
        exact_dedup.DigestIndex(spark, folder, buckets=4)
    again = exact_dedup.DigestIndex(spark, folder)  # the session's number of partitions is another
    assert again.buckets == 3
    later = rows(exact_dedup.judge(docs(spark, [(100, "same words here"), (101, "new"), (None, "new")]), again))
    assert later[100].keep_id == 4 and not later[100].kept and later[101].kept and not later[None].kept
    assert exact_dedup.judge(nothing, again).count() == 0
    assert "Exchange" not in again.read().groupBy("text_sha256").count()._jdf.queryExecution().executedPlan().toString()
    again.close()


def test_one_row_of_each_text_is_left(spark):
    frame = docs(spark, [(1, "a"), (1, "a"), (2, "b"), (3, "b"), (None, "c"), (4, None), (5, "")])
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "test-index"), buckets=2)
    left = exact_dedup.deduplicate(frame, index)
    assert left.columns == frame.columns
    assert sorted(((r.doc_id or -1), r.text) for r in left.collect()) == [(-1, "c"), (1, "a"), (3, "b"), (5, "")]
    index.close()


def test_one_row_of_each_text_is_marked_as_kept(spark):
    given = [(1, "a")] * 40 + [(0, "a")] * 9 + [(None, "a")] * 5 + [(None, "c")] * 30 + [(2, "b"), (3, "b")]
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "test-index"), buckets=2)
    for _ in range(2):  # entered again, it is one row as well
        found = exact_dedup.judge(docs(spark, given), index).collect()
        assert len(found) == len(given)
        assert sorted((r.doc_id or -1, r.group_size) for r in found if r.kept) == [(-1, 30), (1, 54), (3, 2)]
    assert {r.kept for r in exact_dedup.judge(docs(spark, [(0, "a")]), index).collect()} == {False}
    index.close()


# --- rules -------------------------------------------------------------------------------------------------------


def test_measurements(odd, nothing):
    found = rows(rules.ledger(odd))
    assert found[0].n_words == found[2].n_words == 0 and found[0].failed_rules == 1
    assert found[10].n_words == found[10].n_repeat_words == 40_000
    assert rules.measure("a b c d a b c\na b c d\nx\nx\n \n \n")[:6] == (13, 13, 0, 1, 11, 4)
    assert rules.ledger(nothing).count() == 0


def test_ablations_agree_with_policies(odd):
    entries = rules.ledger(odd).cache()
    for policy, names in rules.POLICIES.items():
        bits = [r.failed_rules for r in entries.collect()]
        for row in rules.ablations(entries, policy).collect():
            own = rules.bit(row.rule)
            whole = rules.mask(policy)
            assert row.failed == sum(b & own > 0 for b in bits)
            assert row.alone == sum(b & whole == own for b in bits)
            assert row.kept_without == sum(b & whole & ~own == 0 for b in bits)
        assert rules.apply_policy(entries, policy).where("kept").count() == sum(b & rules.mask(policy) == 0 for b in bits)
        assert set(names) <= set(rules.RULES)


def test_policies_and_ablations_read_the_stored_ledger(spark):
    found = queries.queries()["op6_quality_rules"](spark, FOLDER)
    assert any("quality-ledger" in file for file in found.inputFiles()) and "MapInArrow" not in found._jdf.queryExecution().toString()
    bits = [r.failed_rules for r in found.collect()]
    cost = queries.queries()["quality_rule_ablations"](spark, FOLDER).collect()
    assert sorted((r.policy, r.rule) for r in cost) == sorted((p, r) for p, names in rules.POLICIES.items() for r in names)
    for r in cost:
        own, whole = rules.bit(r.rule), rules.mask(r.policy)
        assert r.failed == sum(b & own > 0 for b in bits) and r.alone == sum(b & whole == own for b in bits)
        assert r.kept_without == sum(b & whole & ~own == 0 for b in bits)


# --- passages ----------------------------------------------------------------------------------------------------


def cut_by_force(texts, length=50):
    first = {}
    for i, text in sorted(texts, key=lambda t: (t[0] is not None, t[0])):
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            first.setdefault(data[p:p + length], i)
    out = []
    for i, text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p:p + length]] != i:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def shuffled_copies():
    rng = random.Random(5)
    common = ["".join(rng.choice("abc ") for _ in range(rng.randint(50, 300))) for _ in range(6)]
    texts = []
    for i in range(120):
        parts = [rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice("defg ") for _ in range(60)) for _ in range(4)]
        texts.append((i, "".join(parts)))
    return texts + [(200 + i, common[0] + str(i)) for i in range(40)] + [(None, common[1]), (7, common[2])]


@pytest.mark.parametrize("texts", [ODD, shuffled_copies()])
@pytest.mark.parametrize("hot", [256, 2])
def test_passages(spark, monkeypatch, texts, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    found = suffix_dedup.passages(docs(spark, texts), block_bytes=4000, task_bytes=10_000).collect()
    assert Counter(tuple(r) for r in found) == cut_by_force(texts)


def test_crowded_landmarks():
    rows_ = []
    for i in range(4):
        prints = np.tile(np.arange(3, dtype="<u8") + 10 * (i % 2), 2)
        rows_.append((suffix_dedup._pack(np.full(3, 9, "<u4").tobytes()), prints.tobytes(), suffix_dedup._pack(np.full(3, i, "<i8").tobytes())))
    codes = [list(suffix_dedup._unpack(c)) for c in suffix_dedup._answers_for(rows_)]
    assert codes == [[suffix_dedup.COMPARE] * 3] * 2 + [[suffix_dedup.GONE] * 3] * 2


def test_segments_that_agree_in_half_a_fingerprint_are_compared():
    rows_ = []
    for i in range(4):
        prints = np.array([5, i % 2], "<u8")
        rows_.append((suffix_dedup._pack(np.full(1, 9, "<u4").tobytes()), prints.tobytes(), suffix_dedup._pack(np.full(1, i, "<i8").tobytes())))
    codes = [list(suffix_dedup._unpack(c)) for c in suffix_dedup._answers_for(rows_)]
    # each content is at least compared as text; what has no equal fingerprint of a smaller id doesn't go
    assert codes[0] == codes[1] == [suffix_dedup.COMPARE]
    assert all(c[0] in (suffix_dedup.COMPARE, suffix_dedup.GONE) for c in codes[2:])


@pytest.mark.parametrize("letters", ["ab", "a", "abc\0", "\0"])
def test_longest_previous_factors(letters):
    rng, length, width = random.Random(len(letters)), 50, suffix_dedup.SEGMENT - 1
    common = ["".join(rng.choice(letters) for _ in range(length - 2)) for _ in range(3)]
    strings = [(rng.choice(common) + "".join(rng.choice(letters) for _ in range(rng.randint(2, width + 2)))).encode() for _ in range(150)]
    ranks = [rng.randint(-2, 20) for _ in strings]
    ranks[0] = suffix_dedup.BEFORE_ALL
    suffixes = [(string[at:], rank) for string, rank in zip(strings, ranks, strict=True) for at in range(len(string) - length + 1)]
    text = b"".join(strings)
    begins = np.cumsum([0, *map(len, strings)])
    starts = np.array([begins[n] + at for n, string in enumerate(strings) for at in range(len(string) - length + 1)])
    sizes, of = np.array([len(x) for x, _ in suffixes]), np.array([r for _, r in suffixes])
    found = suffix_dedup._longest_previous_factors(text, starts, sizes, of, length)

    def shared(a, b):
        return next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    for (own, rank), factor in zip(suffixes, found.tolist(), strict=True):
        longest = max((shared(own, other) for other, r in suffixes if r < rank), default=0)
        assert factor == (longest if longest >= length else 0)


def test_passages_on_given_documents(spark):
    frame = table(spark, FOLDER, "documents")
    found = suffix_dedup.passages(frame, block_bytes=100_000, with_text=True).collect()
    assert Counter(tuple(r)[:5] for r in found) == cut_by_force([(r.doc_id, r.text) for r in frame.collect()])
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_no_passages(nothing):
    assert suffix_dedup.passages(nothing).count() == 0


# --- tokens ------------------------------------------------------------------------------------------------------


def test_same_tokens_as_the_library(spark, odd, nothing):
    library = Tokenizer.from_file(queries.TOKENIZER)
    rng = random.Random(1)
    letters = "aàbé 中日  \n\t'sre1２0!😀<|endoftext|>"
    made = [(100 + i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))) for i in range(300)]
    made += [(500, "ab" * 5000), (501, "<|endoftext|>" * 3), (502, "<|endoftext|")]
    frame = odd.union(docs(spark, made))
    texts = {r.doc_id: r.text or "" for r in frame.collect()}
    encoded = bpe.encode_documents(frame, queries.TOKENIZER)
    back = rows(bpe.decode_documents(encoded, queries.TOKENIZER))
    digests = rows(bpe.round_trip(frame, queries.TOKENIZER))
    for r in encoded.collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert back[r.doc_id].text == library.decode(ids, skip_special_tokens=False) == texts[r.doc_id]
        assert digests[r.doc_id].ids_sha256 == hashlib.sha256(r.ids).hexdigest()
        assert digests[r.doc_id].decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe.round_trip(nothing, queries.TOKENIZER).count() == 0


# --- near-duplicates ---------------------------------------------------------------------------------------------


def reached(keys, k):
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            if (keys[a] ^ keys[b]).bit_count() <= k:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [find(x) for x in range(len(keys))]


def near_keys(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 8)] + [0, 2**64 - 1]
    keys = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(8)}
    return sorted(keys)


@pytest.mark.parametrize("k", [1, 3])
def test_trie_finds_every_link(k, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 50)
    keys = near_keys(160, k)
    array = np.array(keys, np.uint64)
    found = set()
    for a, b in simhash.trie_links(array, np.array([(0, len(keys), 0, len(keys))]), k):
        pairs = list(zip(a.tolist(), b.tolist(), strict=True))
        assert not found & set(pairs)
        found |= set(pairs)
    assert found == {(a, b) for b in range(len(keys)) for a in range(b) if (keys[a] ^ keys[b]).bit_count() <= k}


@pytest.mark.parametrize("crowd", [3, 20_000])
def test_links_and_components(spark, crowd):
    keys = near_keys(200, 9)
    signed = [int(np.uint64(x).astype(np.int64)) for x in keys]
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    found = {r.node: r.root for r in simhash.components(simhash.links(frame, 3, crowd)).collect()}
    groups, expected = {}, {}
    for i, root in enumerate(reached(keys, 3)):
        expected.setdefault(root, set()).add(signed[i])
        groups.setdefault(found.get(signed[i], signed[i]), set()).add(signed[i])
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("crowd", [2, 40])
def test_crowded_block_is_divided_until_small(spark, crowd):
    """One block value holds all keys, a dense cluster among them: pairs across nodes are divided more than once."""
    rng = random.Random(4)
    low = [rng.getrandbits(48) for _ in range(60)]
    dense = [low[0] ^ (1 << i) ^ (1 << j) for i in range(48) for j in range(i)][:300]
    near = [x ^ sum(1 << b for b in rng.sample(range(48), rng.randint(1, 4))) for x in low for _ in range(4)]
    keys = sorted({(0xABCD << 48) | x for x in low + dense + near})
    signed = [int(np.uint64(x).astype(np.int64)) for x in keys]
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    found = {r.node: r.root for r in simhash.components(simhash.links(frame, 3, crowd)).collect()}
    groups, expected = {}, {}
    for i, root in enumerate(reached(keys, 3)):
        expected.setdefault(root, set()).add(signed[i])
        groups.setdefault(found.get(signed[i], signed[i]), set()).add(signed[i])
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_dense_group_needs_no_visit_per_link():
    keys = np.unique(np.array([sum(1 << b for b in c) for c in itertools.combinations(range(40), 3)], np.uint64))
    visited = 0
    roots = np.array([(0, len(keys), 0, len(keys))])
    for a, _ in simhash.trie_links(keys[:2000], np.array([(0, 2000, 0, 2000)]), 3):
        visited += len(a)
    assert visited > 50_000
    assert not simhash.spanning(keys, roots, 3).any()


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "a bigint, b bigint")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, 101: 100}
    assert simhash.components(edges.where("a < 0")).count() == 0


def fingerprint_by_force(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, odd, nothing):
    for frame in (odd, table(spark, FOLDER, "documents")):
        texts = sorted((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())
        prints = [fingerprint_by_force(t) for _, t in texts]
        found = rows(simhash.near_duplicates(frame))
        for (i, _), fp, root in zip(texts, prints, reached(prints, 3), strict=True):
            assert found[i].fp & (2**64 - 1) == fp and found[i].component_id == texts[root][0]
        left = simhash.keep_first(frame)
        assert left.columns == frame.columns
        assert set(rows(left)) == {r.component_id for r in found.values()}
    assert simhash.near_duplicates(nothing).count() == 0
    repeated = docs(spark, [(None, "a b c d"), (None, "a b c d"), (5, "q r s t")])
    assert simhash.near_duplicates(repeated).count() == 3


def test_one_document_of_each_group_stays_whatever_the_ids(spark):
    base = [f"w{i}" for i in range(400)]
    first, near, other = " ".join(base), " ".join([*base[:-1], "changed"]), " ".join(f"v{i}" for i in range(400))
    assert (simhash.fingerprint(first) ^ simhash.fingerprint(near)).bit_count() <= 3

    def left(*given):
        return sorted(((r.doc_id, r.text) for r in simhash.keep_first(docs(spark, given)).collect()), key=str)

    # one row with a NULL or repeated id is linked to a smaller id; others of that id aren't
    assert left((1, first), (None, near), (None, other)) == [(1, first), (None, other)]
    assert left((1, first), (7, near), (7, other)) == [(1, first), (7, other)]
    # near copies that share an id or have none
    assert [i for i, _ in left((None, first), (None, near), (None, None))] == [None, None]
    assert len(left((4, first), (4, near), (4, other), (9, near))) == 2
    # rows that repeat id and text
    assert left((3, first), (3, first), (None, other), (None, other)) == [(3, first), (None, other)]


# --- queries and pipeline ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sql.oracle_sql())
def test_query(spark, name):
    assert difference(queries.queries()[name](spark, FOLDER), duck(FOLDER), sql.oracle_sql()[name]) is None


def test_pipeline(spark):
    given = table(spark, FOLDER, "documents")
    now, sizes = given, [given.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = stage(spark, now, FOLDER).cache()
        if name != "bpe":
            assert now.columns == given.columns
        if name == "exact_dedup":
            last = {r.text or "": r.doc_id for r in before.orderBy("doc_id").collect()}
            assert sorted(r.doc_id for r in now.collect()) == sorted(last.values())
        if name == "simhash":
            found = simhash.near_duplicates(before).collect()
            assert sorted(r.doc_id for r in now.collect()) == sorted({r.component_id for r in found})
        sizes.append(now.count())
    library = Tokenizer.from_file(queries.TOKENIZER)
    texts = {r.doc_id: r.text for r in given.collect()}
    assert all(np.frombuffer(r.ids, "<u4").tolist() == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in now.collect())
    assert sizes[1] > 0.7 * sizes[0] and corpus_pipeline.run(spark, FOLDER).count() == sizes[-1]


def test_pipeline_decodes_what_it_encodes(spark, odd, nothing):
    stage = dict(corpus_pipeline.STAGES)["bpe"]
    encoded = rows(bpe.encode_documents(odd, queries.TOKENIZER))
    found = stage(spark, odd, FOLDER).collect()
    assert len(found) == len(ODD) and stage(spark, nothing, FOLDER).count() == 0
    texts = {i: t or "" for i, t in ODD}
    for r in found:
        assert r.ids == encoded[r.doc_id].ids and r.n_tokens == encoded[r.doc_id].n_tokens
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.same_text
