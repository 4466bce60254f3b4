"""URL filters, nearest neighbours, mixing, sharding and the pipeline against brute force."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import ann, mixing, sharding, url_filters


def list_verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in url_filters.RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def pages(spark):
    rng = random.Random(1)
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(['www.', '', 'M.'])}{rng.choice(['a', 'b', 'ads'])}.Example.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'fr', 'es'])}/{rng.randint(1, 99)}{rng.choice(['', '?q=1', '#t'])}" for _ in range(300)]
    urls += [None, "", "no scheme/en/", "http://", "x://com?y=/a", "http://example.com", "http://EXAMPLE.com/en/\nnext", "a://b://net/es/"]
    rows = list(enumerate(urls)) + [(None, urls[0]), (0, urls[0])]
    return spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("clash")), rows


def test_listed_urls(spark):
    table, rows = pages(spark)
    found = url_filters.judge(table).collect()
    got = collections.Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in found)
    assert got == collections.Counter((i, *list_verdict(u)) for i, u in rows)
    assert {r["verdict"] for r in found} <= {"allow", "block"}


def test_mined_rules_against_counting(spark):
    import itertools

    table, rows = pages(spark)
    tokens = table.select("url", url_filters.tokens(F.col("url")).alias("tokens")).collect()
    labelled = [(r["tokens"], list_verdict(r["url"])[3]) for r in tokens]
    data = spark.createDataFrame(labelled, "tokens array<string>, verdict string")
    mined = {(tuple(r["antecedent"]), r["verdict"]): r["confidence"] for r in url_filters.mine(data, 0.05, 0.8).collect()}
    taught = [(set(t), v) for t, v in labelled if v and t]
    want = {}
    for n in (1, 2, 3):
        for some in itertools.combinations(sorted(set().union(*(t for t, _ in taught))), n):
            holds = [v for t, v in taught if t >= set(some)]
            for verdict in ("allow", "block"):
                k = holds.count(verdict)
                if k >= 0.05 * len(taught) and k and k / len(holds) >= 0.8:
                    want[some, verdict] = k / len(holds)
    pruned = {x: c for x, c in want.items() if not any(set(y[0]) < set(x[0]) and y[1] == x[1] and d >= c for y, d in want.items())}
    assert mined.keys() == pruned.keys() and all(math.isclose(mined[k], pruned[k]) for k in mined)
    urls = spark.createDataFrame([(r["tokens"],) for r in tokens], "tokens array<string>")
    matched = {tuple(r["tokens"]) for r in url_filters.match(urls, url_filters.mine(data, 0.05, 0.8)).collect()}
    assert matched == {tuple(r["tokens"]) for r in tokens if any(set(a) <= set(r["tokens"]) for a, _ in pruned)}


def vectors():
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(1500, 16)) + rng.integers(0, 4, (1500, 1)) * 2).astype(np.float32)
    x[100:400] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return rows, x.astype(np.float64)


def test_nearest(spark):
    rows, x = vectors()
    odd = [(5000, None), (5100, [0.0] * 16), (5200, [float("nan")] * 16), (5300, [1.0, None] * 8), (None, [1.0] * 16), (5400, []), rows[100], (6000, [1.0, 2.0]), (6001, [1.0, 3.0])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0))
    found = ann.search(table, table.where("vec_id % 100 = 0"), shard_rows=300, block=7).collect()
    got = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == {*range(0, 1500, 100), 6000} and [v for v, _ in got[6000]] == [6001]
    hits = 0
    for q in range(0, 1500, 100):
        far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = [v for v in np.lexsort((np.arange(1500), far)) if v != q][:10]
        hits += len(set(want) & {v for v, _ in got[q]})
        assert got[q] == sorted(got[q], key=lambda p: (p[1], p[0]))
        assert np.allclose([s for _, s in got[q]], far[[v for v, _ in got[q]]], rtol=1e-9)
    assert hits >= 0.95 * 150
    assert [v for v, _ in got[200]] == list(range(100, 110))
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")
    assert ann.search(few, few.where("vec_id = 0")).count() == 3
    assert ann.search(few.limit(0), few.limit(0)).count() == 0


def documents(spark, n=600):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.1) * 5)), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(n)]
    rows += [(9000, None, None), (9001, "", "empty"), (9002, "a b", None), (9003, "x y", None), (1, "w w", "s1"), (1, "w w", "s1"), (None, "q r s", "hot")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def test_mixing(spark):
    table, rows = documents(spark)
    found = mixing.mix(table.withColumn("size", F.lit("clash")).withColumn("copies", F.lit(0)), cell_rows=50).collect()
    assert len(found) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = dict(zip(order, [3, 1, 2] * 9, strict=False))
    want, open_, pool = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        level = pool / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        want |= {s: 2.0 * sizes[s] for s in over}
        pool -= sum(2 * sizes[s] for s in over)
        open_ -= over
    want |= {s: weight[s] * level for s in open_}
    taken = collections.Counter()
    for r in found:
        assert 0 <= r["copies"] <= 2 and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9) and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] + 1 for s in order)
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["copies"])
    again = mixing.mix(table.repartition(3), cell_rows=50).collect()
    assert sorted(map(key, again)) == sorted(map(key, found))
    out = mixing.expand(table.withColumn("copies", F.lit("mine")), cell_rows=50)
    assert out.columns == ["doc_id", "text", "source", "copies"]
    got = collections.Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in out.collect())
    assert got == collections.Counter({k: n for k, n in collections.Counter((r["doc_id"], r["source"], r["size"]) for r in found for _ in range(r["copies"])).items()})


def test_mixing_of_many_sources_and_numbers(spark, monkeypatch):
    """The branches that join by shuffle give what the broadcasts give; columns of every helper's name stay."""
    table, _ = documents(spark, 120)
    table = table.withColumn("_size", F.lit(77)).withColumn("size", F.lit("s")).withColumn("whole", F.lit(1)).withColumn("_turn", F.lit(2))
    key = lambda r: tuple(map(str, r))
    want = sorted(map(key, mixing.expand(table, cell_rows=50).collect()))
    monkeypatch.setattr(mixing, "MOST_SOURCES", 0)
    monkeypatch.setattr(mixing, "MOST_BROADCAST_ROWS", 0)
    out = mixing.expand(table, cell_rows=50)
    assert out.columns == table.columns
    found = out.collect()
    assert sorted(map(key, found)) == want and all((r["_size"], r["size"], r["whole"], r["_turn"]) == (77, "s", 1, 2) for r in found)


def test_tilts_solve_the_dual(spark):
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 4000, 300)
    share = 0.37
    histogram = spark.createDataFrame([("s", int(z), 1) for z in sizes], "source string, size long, n long").groupBy("source", "size").agg(F.count("*").alias("n"))
    goals = spark.createDataFrame([("s", int(sizes.sum()), float(share * sizes.sum()))], "source string, source_size long, target double")
    r = mixing.balance(histogram, goals).first()
    rate = 2 / (1 + np.exp(-r["tilt"] * sizes / r["mean"]))
    assert math.isclose((rate * sizes).sum(), share * sizes.sum(), rel_tol=1e-4)


def test_sharding(spark):
    table, rows = documents(spark)
    found = sharding.interleave(table.withColumn("shard", F.lit(1)), cell_rows=40).collect()
    counts = collections.Counter(r["shard"] for r in found)
    assert len(found) == len(rows) and set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for k in range(16):
        assert sorted(r["slot"] for r in found if r["shard"] == k) == list(range(counts[k]))
    hot = collections.Counter(r["shard"] for r in found if r["source"] == "hot")
    # A shard ends between rows of different sources: each may be off by a row or two.
    assert max(hot.values()) - min(hot.values()) <= 4
    raw = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert raw == collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found)


@pytest.mark.parametrize("run", [mixing.mix, mixing.expand, sharding.interleave])
def test_empty(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_empty_pages(spark):
    assert url_filters.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(6)
    words = {"en": ["the", "of", "and", "thing", "with"], "de": ["der", "und", "nicht", "ein", "mit"]}
    text = lambda lang: " ".join(rng.choice(words[lang]) + rng.choice(["", "er", "en"]) for _ in range(rng.randint(20, 80)))
    rows = [(i, text(lang := rng.choice(["en", "de"])), lang, f"s{i % 4}", 0) for i in range(150)]
    rows += [(200, rows[3][1], "en", "s0", 0), (201, "12 34 !!", "en", "s1", 0), (202, None, "en", "s1", 0), (203, rows[5][1] + " mail me.at@home.example.com", "en", "s2", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        assert docs.columns == before.columns, name
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append({r["doc_id"] for r in docs.collect()})
    assert {201, 202}.isdisjoint(counts[0]) and len(counts[0]) == 152
    assert 200 not in counts[1] and {3, 5} <= counts[1]
    assert not any("@" in r["text"] for r in spark.read.parquet(str(tmp_path / "pii")).collect())
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.countDistinct("sequence_id")).first()[0] >= 1
