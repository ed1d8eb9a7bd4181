"""Every stage of the pipeline against decisions taken document by document in plain Python, and columns that clash."""

import random
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

ENGLISH = "the river runs under an old bridge where people of this town meet and talk about weather work and children".split()
GERMAN = "der fluss zieht unter einer alten brücke durch wo sich leute aus dieser stadt treffen und über wetter arbeit sprechen".split()
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def sentence(words, seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    """Documents of two languages, exact copies, near copies in a chain, and texts that no language has."""
    rows = [(i, "s", "en" if i % 2 else "de", 0, sentence(ENGLISH if i % 2 else GERMAN, i, 40 + i % 50)) for i in range(300)]
    rows += [(1000 + i, "s", None, 0, rows[i][4]) for i in range(0, 40)]                         # exact copies
    chain = sentence(ENGLISH, 7777, 200).split()
    for i in range(12):                                                                          # each near the one before it
        chain = chain[:i * 9] + [f"other{i}"] + chain[i * 9 + 1:]
        rows.append((2000 + i, "t", "en", 0, " ".join(chain)))
    rows += [(3000 + i, "junk", None, 0, "".join(random.Random(i).choice("0123456789+/=;{}") for _ in range(400))) for i in range(5)]
    rows += [(3100, "junk", None, 0, None), (3101, "junk", None, 0, ""), (3102, "s", "en", 0, sentence(ENGLISH, 5, 9000))]
    return rows


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def without_near(rows):
    """Brute force: smallest id of each group that pairs at 0.75 connect."""
    sets = {r[0]: shingles(r[4]) for r in rows}
    root = {i: i for i in sets}
    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return [r for r in rows if top(r[0]) == r[0]]


def test_run_against_plain_decisions(spark, planted, tmp_path):
    spark.createDataFrame(planted, SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    told = {r[0] for r in corpus_pipeline.drop_undetermined(spark, docs, "").select("doc_id").collect()}
    assert not told & {3000, 3001, 3002, 3003, 3004, 3100, 3101}          # junk, null and empty
    assert told == {r[0] for r in planted} - {3000, 3001, 3002, 3003, 3004, 3100, 3101}
    last = {}
    for r in planted:
        if r[0] in told and (r[4] not in last or last[r[4]][0] < r[0]):
            last[r[4]] = r
    kept = without_near(list(last.values()))
    assert {r[0] for r in kept} & set(range(2000, 2012)) == {2000}
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter({r[0]: len(encode.encode(r[4], add_special_tokens=False).ids) + 1 for r in kept})
    got, sequences = Counter(), defaultdict(list)
    for piece in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[piece["doc_id"]] += piece["length"]
        sequences[piece["sequence_id"]].append((piece["offset"], piece["length"]))
    assert got == want
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096


def test_stages_keep_columns_that_clash(spark, planted):
    extra = ", lang_pred string, score string, rejected string, _sha string, _row int, sha string, kept string, m map<string,int>, c0 string"
    more = ("p", "7", "r", "a", 1, "b", "k", {"x": 1}, "c")
    rows = [(*r, *more) for r in planted[:120] + planted[300:345]]
    rows += [(*planted[0], *more[:-1], "b"), (None, *planted[1][1:], *more), (5, "s", "en", 0, sentence(ENGLISH, 9, 60), *more)]
    docs = spark.createDataFrame(rows, SCHEMA + extra)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.schema.names == docs.schema.names and [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        left = after.collect()
        assert left and not {str(r) for r in left} - {str(r) for r in docs.collect()}
        assert stage(spark, docs.where("false"), "").count() == 0


def test_stages_hand_on_small_batches(spark):
    """A task holds 2 MB of texts and a row at once, not all its rows; a size that the session has of its own stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, "s", "en", 0, sentence(ENGLISH, i, 20_000)) for i in range(100)], SCHEMA).coalesce(1)

    def largest():
        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])
        return docs.select("text").mapInArrow(sizes, "size bigint").agg({"size": "max"}).first()[0]

    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(key)
        stage(spark, docs.limit(3), "")
        assert largest() < 3 << 20
        spark.conf.set(key, "1m")
        stage(spark, docs.limit(3), "")
        assert spark.conf.get(key) == "1m"
    spark.conf.unset(key)
