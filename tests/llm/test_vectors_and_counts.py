"""Embedding near-dedup, token rollups, components and the pipeline."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

import corpus_pipeline
from invoicemill.llm import embedding_dedup as near, queries, token_rollup as rollup
from invoicemill.llm.components import components
from invoicemill.session import new_folder


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 380)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    parent = {x: x for l in links for x in l}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = {row["node"]: row["component"] for row in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {x: root(x) for x in linked}


def cluster(seed, n, spread, dim=16):
    r = np.random.default_rng(seed)
    centre = r.normal(size=dim)
    return [(centre + spread * r.normal(size=dim)).tolist() for _ in range(n)]


def test_embedding_dedup(spark):
    vectors = cluster(1, 300, 0.1) + cluster(2, 40, 0.05) + [v for s in range(3, 400) for v in cluster(s, 1, 1.0)]
    vectors += [vectors[0]] * 30 + [[2 * x for x in vectors[5]]]
    odd = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 3, [], [float("inf")] + [1.0] * 15]
    rows = [(i, v, 1, 0, "h") for i, v in enumerate(vectors + odd)] + [(None, vectors[0], 1, 0, "h")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, home int, visits string").repartition(3)
    got = {r["vec_id"]: r for r in near.embedding_dedup(table).collect()}
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1)[:, None]
    close = x @ x.T >= 0.9
    n = close.sum(1) - 1
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= n).all() and found.sum() >= 0.9 * n.sum()
    for i in range(len(vectors), len(vectors) + len(odd)):
        assert tuple(got[i]) == (i, 0, i, True)
    assert tuple(got[None]) == (None, 0, None, True) and len(got) == len(rows)
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in range(len(x)))


def planted_vectors(spark):
    """The given vectors, a near partner of each of the first 500 of them, and a group of 400 around one."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in given], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise = np.random.default_rng(5).normal(size=(400, x.shape[1])) / np.sqrt(x.shape[1])
    more = np.concatenate([near.planted(x[:500], 0.93), x[1000] + 0.1 * noise])
    rows = [(r["vec_id"], v.tolist()) for r, v in zip(given, x)] + [(1_000_000 + i, v.tolist()) for i, v in enumerate(more)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)


def test_embedding_recall_on_the_table(spark):
    vectors = planted_vectors(spark)
    got = near.embedding_dedup(vectors).toPandas().sort_values("vec_id")
    given = vectors.select("vec_id", "embedding").toPandas().sort_values("vec_id")
    x = np.array(given.embedding.tolist(), float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    n = np.concatenate([(x[i:i + 1000] @ x.T >= 0.9).sum(1) - 1 for i in range(0, len(x), 1000)])
    assert n.sum() > 100_000 and (got.n_links.values <= n).all() and got.n_links.sum() >= 0.9 * n.sum()
    assert got.n_links[(n > 0) & (n < 5)].sum() >= 0.9 * n[n < 5].sum()
    # Components by brute force: labels run along links until nothing changes; where no link is missed they are the same.
    label, close = given.vec_id.values.copy(), x @ x.T >= 0.9
    while (least := np.where(close, label, label.max()).min(1)).tolist() != label.tolist():
        label = least
    whole = np.isin(label, label[got.n_links.values < n], invert=True)
    assert whole.mean() > 0.5 and (got.component_id.values[whole] == label[whole]).all() and (got.component_id.values >= label).all()


def test_embedding_small_groups(spark):
    """Pairs beside one huge group: of the few vectors drawn hardly any two are a pair, so their links have to be looked for among all vectors."""
    r = np.random.default_rng(11)
    base = r.normal(size=(1500, 16))
    base /= np.linalg.norm(base, axis=1)[:, None]
    x = np.concatenate([base, near.planted(base, 0.91), r.normal(size=16) + 0.01 * r.normal(size=(1500, 16))])
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>").repartition(3)
    got = {row["vec_id"]: row["n_links"] for row in near.embedding_dedup(table, sample=200, queries=500).collect()}
    x /= np.linalg.norm(x, axis=1)[:, None]
    n = (x @ x.T >= 0.9).sum(1) - 1
    assert all(got[i] <= n[i] for i in got)
    small = [i for i in got if 1 <= n[i] <= near.FEW]
    assert len(small) >= 2900 and sum(got[i] for i in small) >= 0.99 * sum(n[i] for i in small)


def test_embedding_links_beyond_the_queries(spark):
    """Where no query has a link, the depth is fitted on planted pairs at the threshold and holds for others of their kind."""
    r = np.random.default_rng(12)
    x = r.normal(size=(3000, 32))
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    units = table.select("vec_id", near.F.col("embedding").alias("unit"))
    queries, of, partners, few, all_asked = near.true_links(units, 3000, 32, 1e9, 100)
    assert len(queries) == len(of) == len(partners) == len(few) == 0 and not all_asked
    base = x / np.linalg.norm(x, axis=1)[:, None]
    index = near.fit(base, 3000, base[:200], np.arange(200), near.planted(base[:200], 0.9), np.ones(200, bool))
    assert min(index.recall, index.recall_few) >= near.TARGET_RECALL
    other, home = base[200:1200], index.homes(near.planted(base[200:1200], 0.9, 7))
    assert np.mean([h in set(v) for h, v in zip(home.tolist(), index.visits(other))]) >= 0.97


def test_traversal_is_in_order_of_distance():
    r = np.random.default_rng(3)
    a, b = r.random(9), r.random(7)
    sums = (a[:, None] + b[None, :]).ravel()
    assert np.allclose(sums[near.traverse(a, b, 63)], np.sort(sums))


def test_embedding_empty(spark):
    assert near.embedding_dedup(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    assert [tuple(r) for r in near.embedding_dedup(spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")).collect()] == [(1, 0, 1, True)]


CHANGES = "op string, doc_id bigint, source string, lang string, tokenizer_version string, tokens bigint, documents int, part string"


def test_vectors_of_all_lengths(spark):
    """Vectors are compared within their length; components and counts against brute force."""
    r = np.random.default_rng(8)
    vectors = {1: [2.0], 2: [3.0], 3: [-1.0], 4: [], 5: [], 6: None, 7: [0.0, 0.0, 0.0], 8: [1.0, 2.0, 3.0], 9: [1.0, 2.0, 3.0], 10: [1.0, 2.0, None], 11: [1.0, float("nan"), 0.0]}
    for i in range(60):
        vectors[20 + i] = (np.eye(16)[i % 5] + 0.12 * r.standard_normal(16)).tolist()
    docs = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors.items()], "vec_id bigint, embedding array<double>, unit string, side int")
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors.items() if v and None not in v and np.isfinite(v).all() and np.any(v)}
    linked = {i: {j for j, b in unit.items() if j != i and len(a) == len(b) and a @ b >= 0.9} for i, a in unit.items()}
    want = {}
    for i in vectors:
        found, todo = {i}, [i]
        while todo:
            for j in linked.get(todo.pop(), ()):
                if j not in found:
                    found.add(j), todo.append(j)
        want[i] = (len(linked.get(i, ())), min(found), min(found) == i)
    assert {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in near.embedding_dedup(docs).collect()} == want


def test_smallest_id_reached():
    rows, columns = near.reached(np.eye(4, dtype=bool) | np.eye(4, k=1, dtype=bool), np.array([9, 8, 7, 6]), np.array([15, 14, 13, 12]))
    assert rows.tolist() == [6] * 4 and columns.tolist() == [6] * 4
    assert near.reached(np.zeros((1, 2), bool), np.array([3]), np.array([1, 2]))[0].tolist() == [3]


def test_rollup_against_recount(spark):
    r = random.Random(2)
    totals, state = rollup.Rollup(spark, new_folder(spark, "rollup-test")), {}
    for batch in range(4):
        rows = []
        for _ in range(60):
            doc, op = r.randrange(50), r.choice([rollup.INSERT, rollup.DELETE, rollup.REVISE, "other"])
            rows.append((op, doc, r.choice(["a", "b", None]), r.choice(["en", None]), f"v{r.randrange(2)}", r.choice([1, 5, None])))
        rows += [(rollup.INSERT, None, "a", "en", "v0", 3)] + rows[:3]
        changes = spark.createDataFrame([(*x, 1, "p") for x in rows], CHANGES)
        totals = totals.commit(f"b{batch}", changes)
        order = lambda x: (x[0], x[2] is not None, x[2] or "", x[3] is not None, x[3] or "", x[4], x[5] or 0)
        last = {}
        for x in sorted((x for x in rows if x[1] is not None and x[0] != "other"), key=order):
            last[x[1]] = x
        for doc, x in last.items():
            state.pop(doc, None)
            if x[0] != rollup.DELETE:
                state[doc] = (x[2], x[3], x[4], x[5] or 0)
        want = defaultdict(lambda: [0, 0])
        for source, lang, version, tokens in state.values():
            want[source, lang, version][0] += 1
            want[source, lang, version][1] += tokens
        again = rollup.Rollup(spark, totals.folder, totals.history[:-1]).commit(f"b{batch}", changes)       # a replay
        for t in (totals, totals.commit(f"b{batch}", changes), again):
            assert {tuple(x)[:3]: list(x)[3:] for x in t.totals().collect()} == dict(want)


def test_broken_batch_is_written_anew(spark):
    first = rollup.Rollup(spark, new_folder(spark, "rollup-test"))
    change = lambda n: spark.createDataFrame([(rollup.INSERT, 1, "a", "en", "v", n, 1, "p")], CHANGES)
    change(9).write.parquet(f"{first.folder}/deltas/batch=x")           # left over from a run that broke off
    after = first.commit("x", change(4))
    assert [tuple(r) for r in after.totals().collect()] == [("a", "en", "v", 1, 4)]
    empty = after.commit("y", change(4).where("doc_id > 1"))
    assert [tuple(r) for r in empty.totals().collect()] == [("a", "en", "v", 1, 4)]


def test_an_old_folder_opened_afresh(spark):
    """A new process knows what is committed from the folder alone; runs stay few, and removed documents stay removed through their merging."""
    folder = new_folder(spark, "rollup-test")
    row = lambda op, doc, n: (op, doc, "a", "en", "v", n, 1, "p")
    for i in range(6):
        rows = [row(rollup.INSERT, i, 10), row(rollup.INSERT, 100, i)] + ([row(rollup.DELETE, i - 1, None)] if i % 2 else [])
        changes = spark.createDataFrame(rows, CHANGES)
        rollup.Rollup(spark, folder).commit(f"b{i}", changes)
        rollup.Rollup(spark, folder).commit(f"b{i}", changes)                               # a replay by another process
        assert len(rollup.Rollup(spark, folder).runs) <= 3
    opened = rollup.Rollup(spark, folder)
    assert opened.history == tuple(f"b{i}" for i in range(6))
    assert [tuple(r) for r in opened.totals().collect()] == [("a", "en", "v", 4, 35)]
    assert [tuple(r) for r in rollup.Rollup(spark, folder, ("b0",)).commit("b6", spark.createDataFrame([row(rollup.DELETE, 100, 0)], CHANGES)).totals().collect()] == [("a", "en", "v", 3, 30)]


def test_counts_are_the_tokenizers(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r["doc_id"]: len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()}
    assert {r["doc_id"]: r["tokens"] for r in rollup.count_tokens(docs, path).collect()} == want


def test_token_counts_query(spark):
    """The registered query against a recount document by document."""
    from tokenizers import Tokenizer
    sf = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    toxic, low = set(), set()
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        toxic |= {r["doc_id"]} if r["toxic"] == 1 else set()
        low |= {r["doc_id"]} if r["quality"] == 0 else set()
    want, shortened = defaultdict(lambda: [0, 0]), 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = r["text"] or ""
        if r["doc_id"] in toxic:
            continue
        if r["doc_id"] in low:
            unique = "\n".join(dict.fromkeys(text.split("\n")))
            shortened += unique != text
            text = unique
        total = want[r["source"], r["lang"], "word_bpe_49k"]
        total[0] += 1
        total[1] += len(tokenizer.encode(text, add_special_tokens=False).ids)
    assert toxic and shortened
    assert {tuple(x)[:3]: list(x)[3:] for x in queries.op3_token_counts(spark, sf).collect()} == dict(want)


def test_pipeline(spark):
    """Each stage keeps the columns of documents and what the operator decides; the last packs what is left."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns
        ids, before = Counter(r[0] for r in after.select("doc_id").collect()), {r[0] for r in docs.select("doc_id").collect()}
        assert set(ids) <= before and max(ids.values()) == 1
        sizes.append((len(before), len(ids)))
        docs = after.cache()
    assert sizes[0][1] >= 0.98 * sizes[0][0]
    texts = [r["text"] for r in docs.collect()]
    assert len(set(texts)) == len(texts)
    packed = corpus_pipeline.run(spark, sf)
    assert {r[0] for r in packed.select("doc_id").collect()} == {r[0] for r in docs.select("doc_id").collect()}


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(400)}" for _ in range(n))


def test_pipeline_null_and_repeated_ids_exact(spark):
    rows = [(None, "alone"), (None, "alone"), (None, "shared"), (1, "shared"), (1, "shared"), (2, "shared"), (2, "shared"), (1, "own"), (3, None), (None, ""), (4, "x")]
    docs = spark.createDataFrame([(i, t, "en", f"s{n}", 1) for n, (i, t) in enumerate(rows)], DOCS).repartition(3)
    after = corpus_pipeline.drop_copies(spark, docs, "")
    assert after.columns == docs.columns
    assert Counter(map(tuple, after.collect())) == Counter([(None, "alone", "en", "s0", 1), (2, "shared", "en", "s5", 1), (1, "own", "en", "s7", 1), (3, None, "en", "s8", 1), (4, "x", "en", "s10", 1)])


def test_pipeline_null_and_repeated_ids_near(spark):
    a, b, c = prose(1), prose(2), prose(3)
    single = [(None, a + " end"), (None, c), (5, a), (3, a + " last"), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in single], DOCS).repartition(3)
    assert Counter(r[:2] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == Counter([single[0], single[1], single[3], single[4]])
    repeated = [*single, (3, b), (7, b + " last"), (5, c + " end"), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in repeated], DOCS).repartition(3)
    after = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert after.columns == docs.columns
    assert Counter(r[:2] for r in after.collect()) == Counter([single[0], single[1], single[3], single[4], (3, b), (5, c + " end"), (5, "")])


def test_queries_are_named():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 11)) and set(queries.ORACLES) <= set(queries.QUERIES)
