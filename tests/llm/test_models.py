"""Toxicity by held-out rows, quality against a plain Kneser-Ney model, and the pipeline stage by stage."""

import collections
import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from prose import prose
from snapledger.llm import mixing, quality, toxicity
from snapledger.llm.oracle import ORACLE
from snapledger.llm.queries import QUERIES
from test_similar import joined
from test_tokens import check_packing


def swapped(spark):
    """Rows that a hash which passes over nulls takes for one another."""
    rows = [(4, None, None, "stone river", 1), (4, "stone river", "stone river", None, 1)]
    rows += [(10 + i, "en", "a", prose(60, i), 1) for i in range(40)]
    schema = "doc_id long, lang string, source string, text string, quality int"
    return spark.createDataFrame(rows, schema)


def test_null_and_text_do_not_change_places(spark):
    docs = swapped(spark)
    judged = quality.judge_quality(docs, docs.select("doc_id", "quality"), 0.999).where("doc_id = 4").collect()
    assert len({r.row_hash for r in judged}) == 2 and {r.keep for r in judged} == {True, False}
    kept = quality.good_documents(docs, docs.select("doc_id", "quality"), 0.999).where("doc_id = 4").collect()
    assert [r.text for r in kept] == ["stone river"]
    plan = mixing.plan_mix(docs, weights=[1.0], share=1.0, most_passes=2.0).where("doc_id = 4").collect()
    assert len({r.row_hash for r in plan}) == 2


def test_rows_that_change_their_order_are_an_error(spark):
    def shuffled(batches):
        for batch in batches:
            yield batch.take(pa.array(np.random.default_rng().permutation(batch.num_rows)))

    rows = swapped(spark).coalesce(1)
    docs = rows.mapInArrow(shuffled, rows.schema)
    with pytest.raises(Exception, match="order of the rows"):
        quality.judge_quality(docs, docs.select("doc_id", "quality"), 0.999, chunk_chars=500).collect()


# --- toxicity ----------------------------------------------------------------
@pytest.fixture(scope="module")
def insults(spark):
    rows = []
    for i in range(900):
        words = prose(40 + i % 30, i).split()
        if i % 5 == 0:
            words[i % 37] = ["blockhead", "nitwit", "dunces"][i % 3]
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()


def test_held_out_rows(spark, insults):
    docs, labels = insults.select("doc_id", "text"), insults.select("doc_id", "toxic")
    weights = toxicity.train(docs, labels.where("doc_id < 700"))
    scored = toxicity.score(docs, weights).join(labels, "doc_id").where("doc_id >= 700").collect()
    assert np.mean([(r.score >= 0.3) == (r.toxic == 1) for r in scored]) > 0.97
    assert 0 < np.count_nonzero(weights) < 3000
    again = toxicity.train(docs.repartition(7), labels.where("doc_id < 700").repartition(3))
    assert np.allclose(weights, again)


def test_labels_of_other_documents_do_not_use_up_the_bound(spark, insults):
    docs, labels = insults.select("doc_id", "text"), insults.select("doc_id", "toxic")
    strangers = spark.range(10_000, 60_000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    want = toxicity.train(docs, labels, most_rows=500)
    assert want.any()
    assert np.array_equal(toxicity.train(docs, labels.unionByName(strangers), most_rows=500), want)


def test_a_rare_word_outlives_the_average(spark):
    """Ten of 4,000 labelled rows hold the word, in some of eight shards only."""
    rows = [(i, prose(30, i) + (" scoundrel" if i % 400 == 7 else ""), int(i % 400 == 7)) for i in range(4000)]
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()
    weights = toxicity.train(data, data, shard_rows=500, epochs=3)
    plain = spark.createDataFrame([(1, prose(30, 9999)), (2, prose(30, 9999) + " scoundrel")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(plain, weights).collect()}
    assert got[2] > got[1]


def train_plainly(rows, shards, epochs, seed):
    """The rule with dictionaries, one coordinate at a time."""
    seen = collections.defaultdict(list)
    for shard in shards:
        z, n = collections.defaultdict(float), collections.defaultdict(float)

        def weight(i):
            over = abs(z[i]) - toxicity.L1
            return -math.copysign(over, z[i]) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2) if over > 0 else 0.0

        own = sorted((r for r in rows if r[0] in shard), key=lambda r: (r[0], r[1]))
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for k in order.permutation(len(own)).tolist():
                at = toxicity.features(own[k][1]).tolist()
                g = 1 / (1 + math.exp(-max(-35, min(35, sum(map(weight, at)))))) - own[k][2]
                for i, w in [(i, weight(i)) for i in at]:
                    sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA
                    z[i] += g - sigma * w
                    n[i] += g * g
        for i in n:
            if n[i]:
                seen[i].append((z[i], n[i]))
    out = np.zeros(1 << toxicity.BITS)
    for i, states in seen.items():
        z, n = (sum(s[k] for s in states) / len(states) for k in (0, 1))
        over = abs(z) - toxicity.L1
        if over > 0:
            out[i] = -math.copysign(over, z) / ((toxicity.BETA + n**0.5) / toxicity.ALPHA + toxicity.L2)
    return out


def test_training_equals_the_plain_rule(spark):
    rows = [(i, prose(12, i) + (" nitwit" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(120)]
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    shard = "pmod(xxhash64(doc_id, 'shard'), 3)"
    shards = [set(r.ids) for r in data.groupBy(F.expr(shard)).agg(F.collect_list("doc_id").alias("ids")).collect()]
    got = toxicity.train(data, data, shard_rows=40, epochs=2)
    assert np.allclose(got, train_plainly(rows, shards, 2, 0)) and got.any()


def test_one_step_of_the_rule():
    model = toxicity.Ftrl(np.zeros(4), np.zeros(4))
    model.learn(np.array([1, 2]), 1.0, 1.0)
    assert model.z.tolist() == [0, -0.5, -0.5, 0] and model.n.tolist() == [0, 0.25, 0.25, 0]
    assert model.weights().tolist() == [0, 0, 0, 0]  # under the L1 bound
    model.z[1] = -3.0
    assert model.weights()[1] == pytest.approx((3 - toxicity.L1) / ((1 + 0.5) / toxicity.ALPHA + toxicity.L2))


def test_toxicity_awkward(spark, awkward, empty, insults):
    labels = insults.select("doc_id", "toxic")
    odd = spark.createDataFrame([(None, 1), (5, None), (6, 1), (6, 0), (7, 3)], "doc_id long, toxic int")
    weights = toxicity.train(insults, labels.unionByName(odd))
    got = toxicity.score(awkward, weights).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (3, 4)}
    assert len(blank) == 1
    stay = toxicity.harmless_documents(awkward.unionByName(insults, allowMissingColumns=True).select(*awkward.columns), labels)
    assert stay.columns == awkward.columns and 700 < stay.count() < 900 + awkward.count()
    assert toxicity.harmless_documents(awkward, labels.limit(0)).count() == awkward.count()
    assert toxicity.score(empty, weights).count() == 0
    nothing = toxicity.train(awkward, odd.limit(0))
    assert not nothing.any()
    with pytest.raises(ValueError):
        toxicity.with_score(awkward, weights, name="n")


def test_registered_toxicity(spark, sf):
    got = QUERIES["op7_toxicity"](spark, sf).collect()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)


# --- quality -----------------------------------------------------------------
def test_a_chunk_is_never_held_as_arrays_over_all_its_places():
    texts = [prose(20 + i % 50, i) for i in range(1500)] * 8 + ["", "é\0x" * 200_000, ""]
    raw = "".join(texts).encode()
    assert len(raw) > 3_000_000
    row = {
        "chunk": [7], "lengths": [[len(t) for t in texts]], "size": [len(raw)], "digest": ["d"],
        "texts": [quality._CODEC.compress(raw, asbytes=True)], "expected": ["d"], "trusted": [list(range(1600))],
    }
    tracemalloc.start()
    asked = pa.Table.from_batches(quality._asked([pa.RecordBatch.from_pydict(row)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000
    counts, every = collections.Counter(), set()
    for i, text in enumerate(texts):
        padded = "\x02" * 3 + text.replace("\0", "\ufffd")
        grams = [padded[k : k + 4] for k in range(len(text))]
        every.update(grams)
        if i < 1600:
            counts.update(grams)
    got = dict(zip(asked["gram"].to_pylist(), asked["n"].to_pylist()))
    assert got == {g: counts[g] for g in every} and len(asked) == len(every) and set(asked["chunk"].to_pylist()) == {7}


def plain_perplexities(trusted, texts, order=4):
    start = "\x02" * (order - 1)
    counts = {order: collections.Counter()}
    for text in trusted:
        padded = start + text
        counts[order].update(padded[i : i + order] for i in range(len(text)))
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(gram[1:] for gram in counts[k + 1])
    cut, total, freed = {}, collections.Counter(), collections.Counter()
    for k in counts:
        n = [sum(c == j for c in counts[k].values()) for j in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        cut[k] = [0.0] + [min(max(j - (j + 1) * y * n[j + 1] / n[j] if n[j] else j * y, 0), j) for j in (1, 2, 3)]
        for gram, c in counts[k].items():
            total[(k, gram[:-1])] += c
            freed[(k, gram[:-1])] += cut[k][min(c, 3)]
    letters = len({c for t in texts for c in t}) + 1

    def p(gram):
        if not gram:
            return 1 / letters
        k, low = len(gram), p(gram[1:])
        all_of = total[(k, gram[:-1])]
        if not all_of:
            return low
        c = counts[k][gram]
        return (c - cut[k][min(c, 3)]) / all_of + freed[(k, gram[:-1])] / all_of * low

    out = []
    for text in texts:
        padded = start + text
        logs = [math.log(p(padded[i : i + order])) for i in range(len(text))]
        out.append(math.exp(-sum(logs) / len(logs)) if logs else None)
    return out


@pytest.mark.parametrize("chunk", [6_000_000, 2_000])
def test_perplexity(spark, chunk):
    rows = [(i, prose(20 + i % 50, i), "en" if i % 3 else "de", "x") for i in range(120)]
    rows += [(200 + i, "".join(chr(97 + (i * j * 7) % 26) for j in range(60)), "en", "x") for i in range(9)]
    rows += [(300, "", "en", "x"), (301, None, "en", "x"), (302, prose(30, 9), None, None), (302, prose(30, 9), None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, chunk string").repartition(3)
    labels = [(i, 1) for i in range(100)] + [(100, 1), (100, 0), (101, None), (None, 1), (200, 0), (999, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {(r.doc_id, r.row_hash): r for r in quality.judge_quality(docs, labels, 0.99, chunk_chars=chunk).collect()}
    texts = [t or "" for _, t, _, _ in rows]
    want = dict(zip([r[0] for r in rows], plain_perplexities(texts[:100], texts)))
    assert len(got) == len(rows) - 1  # two rows are equal in id, language and text
    for (name, _), r in got.items():
        assert (r.perplexity is None) == (want[name] is None)
        if want[name]:
            assert r.perplexity == pytest.approx(want[name], rel=1e-9)
    judged = {name: r for (name, _), r in got.items()}
    assert not judged[205].keep and not judged[300].keep and not judged[301].keep and judged[302].keep
    assert sum(judged[i].keep for i in range(100)) >= 97
    kept = quality.good_documents(docs, labels, 0.99)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        i for i, *_ in rows if judged[i].keep
    )


def test_quality_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (6, 1), (11, 1), (3, 1), (9, 0)], "doc_id long, quality int")
    got = quality.judge_quality(awkward, labels).collect()
    assert len(got) == awkward.count()
    assert {r.doc_id for r in got if r.threshold is None} >= {5, 8, 10}
    assert all(r.keep for r in got if r.doc_id in (5, 8, 10))
    assert quality.good_documents(awkward, labels).columns == awkward.columns
    assert quality.judge_quality(empty, labels).count() == 0
    unlabelled = quality.judge_quality(awkward, labels.limit(0)).collect()
    assert all(r.keep == (r.perplexity is not None) for r in unlabelled)


def test_short_trusted_texts_do_not_excuse_long_junk(spark):
    short_words = lambda text: " ".join(w for w in text.split() if len(w) < 3)
    good = [prose(150 + i, i) for i in range(60)] + ["Xj.", "Qz k", "Vw-y"]
    junk = [short_words(prose(2400 + i, 100 + i)) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good + junk)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 63)) for i in range(83)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judge_quality(docs, labels).collect()}
    short = max(got[i].perplexity for i in (60, 61, 62))
    assert all(got[i].perplexity < short for i in range(63, 83))  # one quantile of all would keep the junk
    assert not any(got[i].keep for i in range(63, 83)) and all(got[i].keep for i in range(63))


# --- the pipeline ------------------------------------------------------------
def test_pipeline_stages(spark, sf, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_copies", "mix", "pack"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], sf).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    given, good, mild, single, mixed, packed = tables
    assert all(t.columns == docs.columns for t in tables[:-1])
    rows = [{r.doc_id: r for r in t.collect()} for t in (given, good, mild, single)]
    for before, after in zip(rows, rows[1:]):
        assert all(before[k] == r for k, r in after.items()) and after
    # Quality: what a model of the trusted texts finds usual for its language.
    judged = quality.judge_quality(given, spark.read.parquet(f"{sf}/labels.parquet")).where("keep").collect()
    assert rows[1].keys() == {r.doc_id for r in judged}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [k for k, r in labels.items() if r.quality == 1]
    assert sum(k in rows[1] for k in clean) >= 0.98 * len(clean)
    # Near copies: one document of each class.
    want = joined([(k, r.text) for k, r in rows[2].items()], 5, 80)
    assert rows[3].keys() == set(want.values())
    # Mix: rows of the stage before, at most twice, sources near their targets.
    counts = collections.Counter(r.doc_id for r in mixed.collect())
    assert counts.keys() <= rows[3].keys() and max(counts.values()) <= 2
    assert all(rows[3][r.doc_id] == r for r in mixed.collect())
    # Packing: every copy is a document of its own.
    got = packed.collect()
    check_packing(got, 1024)
    assert collections.Counter(r.doc_id for r in got if r.piece == 0) == counts
    assert corpus_pipeline.run(spark, sf).count() == len(got)


@pytest.mark.parametrize("kind", ["awkward", "empty"])
def test_pipeline_stages_on_awkward_tables(spark, sf, tmp_path, request, kind):
    docs = request.getfixturevalue(kind)
    for name, stage in corpus_pipeline.STAGES:
        before, columns = docs.collect(), docs.columns
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "pack":
            assert docs.columns == columns
            assert {(r.doc_id, r.text) for r in docs.collect()} <= {(r.doc_id, r.text) for r in before}
    check_packing(docs.collect(), 1024)
    if kind == "empty":
        assert docs.count() == 0


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op1_embedding_near_dedup", "op3_ngram_jaccard_join"])
def test_equals_sql(spark, sf, name):
    from compare import connect, differences

    assert differences(connect(sf), QUERIES[name](spark, sf), ORACLE[name]) == {}


def test_no_python_in_native_queries(spark, sf):
    for name in ("op4_source_mix", "op5_fingerprints"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan, name

