"""The registered queries of this subpackage, each over the whole of its table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from invoicemill.llm import chat_format as chat, language_id, license_scan as licenses, piece_fst, token_rollup as rollup
from invoicemill.llm.conversation_repair import conversation_repair, damaged
from invoicemill.llm.embedding_dedup import embedding_dedup
from invoicemill.llm.exact_dedup import exact_dedup
from invoicemill.llm.line_dedup import line_dedup
from invoicemill.llm.merkle_manifest import FIELDS, MerkleManifest, leaf_digest
from invoicemill.llm.minhash_dedup import minhash_dedup
from invoicemill.llm.packing import pack
from invoicemill.llm.suffix_index import long_match_dedup
from invoicemill.session import new_folder, written


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def PACKING_VOCABULARY() -> str:
    return _vocabulary("word_bpe_49k.json")


def PIECE_MODEL() -> str:
    return _vocabulary("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op2_chat_format(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    same = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", same), (-1, 1, "assistant", same)], "conv_id bigint, turn bigint, role string, text string")
    return chat.conversation_digests(chat.chat_format(turns.unionByName(extra)))


def op3_token_counts(spark, sf_dir):
    """All documents are inserted; then those labelled toxic are deleted and those of low quality revised to the count of
    their text without repeated lines; the second batch is committed twice."""
    docs = _table(spark, sf_dir, "documents")
    version = F.lit("word_bpe_49k").alias("tokenizer_version")
    # One narrow pass counts the whole text and, where that differs, the text without repeated lines; only counts are moved.
    unique_lines = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    form = lambda revised, text: F.struct(F.lit(revised).alias("revised"), text.alias("text"))
    forms = F.array_compact(F.array(form(False, F.col("text")), F.when(unique_lines != F.col("text"), form(True, unique_lines))))
    texts = docs.select("doc_id", "source", "lang", F.xxhash64("text").alias("text_hash"), F.inline(forms))
    counted = written(rollup.count_tokens(texts, PACKING_VOCABULARY()), "token-counts")
    inserted = counted.where("not revised").select(F.lit(rollup.INSERT).alias("op"), "doc_id", "source", "lang", version, "tokens")
    totals = rollup.Rollup(spark, new_folder(spark, "token-rollup")).commit("load", inserted)
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    last = counted.groupBy("doc_id", "source", "lang", "text_hash").agg(F.max_by("tokens", "revised").alias("tokens"))
    op = F.when(F.col("toxic") == 1, rollup.DELETE).otherwise(rollup.REVISE).alias("op")
    changes = last.join(labels.where("toxic = 1 or quality = 0"), "doc_id").select(op, "doc_id", "source", "lang", version, "tokens")
    return totals.commit("labels", changes).commit("labels", changes).totals()


def op4_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    judged = language_id.predict(docs.select("doc_id", "text"), language_id.train(docs))
    return judged.select("doc_id", (~F.coalesce(language_id.may_train(F.col("doc_id")), F.lit(True))).alias("held_out"), "lang_pred", "score", "rejected")


def op5_embedding_dedup(spark, sf_dir):
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op6_packing(spark, sf_dir):
    return pack(_table(spark, sf_dir, "documents"), PACKING_VOCABULARY())


def op7_license_scan(spark, sf_dir):
    """Labels of all words and, where a tag's expression could be read, its postfix form and whether permissive licences meet it."""
    found = licenses.license_scan(_table(spark, sf_dir, "documents")).withColumn("valid", F.expr("filter(expressions, e -> e.valid)"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score", F.array_join("valid.postfix", ";").alias("expressions"),
                        F.expr("if(size(valid) = 0, null, forall(valid, e -> e.permissive))").alias("permissive"))


def op8_minhash_dedup(spark, sf_dir):
    return minhash_dedup(_table(spark, sf_dir, "documents"))


def op9_piece_encode(spark, sf_dir):
    """Ids of every text and the text read back from them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    back = piece_fst.decode(piece_fst.encode(docs, PIECE_MODEL()), PIECE_MODEL())
    text = F.coalesce("text", F.lit(""))
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
                       (F.col("decoded") == text).alias("round_trip"))


def op10_line_dedup(spark, sf_dir):
    return line_dedup(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    """Every leaf with its proof; where the checksum of the id is a multiple of three, folded from a text without capitals."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = leaf_digest([lowered if f == "text" else F.col(f) for f in FIELDS])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return MerkleManifest(_table(spark, sf_dir, "documents"), changed=F.when(chosen, tampered)).versions().drop("n_copied")


def op12_suffix_dedup(spark, sf_dir):
    return long_match_dedup(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    return conversation_repair(damaged(turns), turns.select("conv_id"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_chat_format, op3_token_counts, op4_language_id, op5_embedding_dedup, op6_packing, op7_license_scan,
                                   op8_minhash_dedup, op9_piece_encode, op10_line_dedup, op11_merkle_manifest, op12_suffix_dedup, op13_conversation_repair)}

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: CRC-32 of an ASCII string: a table from the polynomial, then one look-up per character.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, _: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc_t)"""
CRC = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split({}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), "
       "lambda c, b: xor(c >> 8, crc_t[xor(c, b) % 256 + 1])), 4294967295)")


def _sql_leaf(*columns: str) -> str:
    return "sha256(concat(" + ", ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + "))"


def _sql_edit(state: str, cost: str, letter: str) -> str:
    """Eight digits of cost, then the audit: of such strings the least is the cheapest and, among those, the ASCII-least audit."""
    return f"printf('%08d', CAST({state}[:8] AS INT) + {cost}) || '{letter}' || {state}[9:]"


def _sql_state(state: str, keep: list[tuple[str, str]], after: str) -> str:
    """The cheapest edit of a row in a state that waits for a role leading to ``after``."""
    kept = [f"CASE WHEN ok AND c = '{role}' THEN {_sql_edit(to, 't', 'K')} END" for role, to in keep]
    return "least(" + ", ".join([_sql_edit(state, "3", "D"), *kept, f"CASE WHEN ok THEN {_sql_edit(after, 't + 2', 'R')} END"]) + ")"


ORACLES = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE {CRC_TABLE},
fates AS (SELECT *, {CRC.format("CAST(doc_id AS VARCHAR)")} % 3 = 0 AS chosen FROM documents, crc),
texts AS (SELECT *, CASE WHEN chosen THEN {LOWER.format("text")} ELSE text END AS changed FROM fates),
leaves AS (
  SELECT doc_id, lang, chosen, {_sql_leaf("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
    {_sql_leaf("doc_id", "source", "lang", "n_chars", "changed")} AS other FROM texts),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS total FROM leaves),
tree AS (
  SELECT lang, 0 AS level, place, leaf AS digest, total FROM placed
  UNION ALL
  SELECT lang, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (total + 7) // 8 FROM tree WHERE total > 1 GROUP BY lang, level, place // 8, total),
subroots AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS total FROM tree WHERE total = 1),
top AS (
  SELECT 0 AS level, place, subroot AS digest, total FROM subroots
  UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (total + 7) // 8 FROM top WHERE total > 1 GROUP BY level, place // 8, total),
root AS (SELECT digest AS root FROM top WHERE total = 1),
runs AS (SELECT lang, level, place // 8 AS run, list(digest ORDER BY place) AS d FROM tree WHERE total > 1 GROUP BY ALL),
top_runs AS (SELECT level, place // 8 AS run, list(digest ORDER BY place) AS d FROM top WHERE total > 1 GROUP BY ALL),
low AS (
  SELECT doc_id, lang, leaf, place AS pos, 0 AS level, place, CASE WHEN chosen THEN other ELSE leaf END AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT doc_id, low.lang, leaf, pos, low.level + 1, run, sha256(array_to_string(list_concat(d[:place % 8], [folded], d[place % 8 + 2:]), '')),
    proof || array_to_string(list_concat(d[:place % 8], d[place % 8 + 2:]), '')
  FROM low JOIN runs ON low.lang IS NOT DISTINCT FROM runs.lang AND low.level = runs.level AND run = place // 8),
ends AS (SELECT * FROM low QUALIFY row_number() OVER (PARTITION BY lang, pos ORDER BY level DESC) = 1),
high AS (
  SELECT doc_id, e.lang, leaf, pos, subroot, 0 AS level, s.place, folded, proof FROM ends e JOIN subroots s ON e.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT doc_id, lang, leaf, pos, subroot, high.level + 1, run, sha256(array_to_string(list_concat(d[:place % 8], [folded], d[place % 8 + 2:]), '')),
    proof || array_to_string(list_concat(d[:place % 8], d[place % 8 + 2:]), '')
  FROM high JOIN top_runs ON high.level = top_runs.level AND run = place // 8)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM (SELECT * FROM high QUALIFY row_number() OVER (PARTITION BY lang, pos ORDER BY level DESC) = 1), root""",
    "op12_suffix_dedup": """
WITH texts AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
pieces AS (SELECT doc_id, unnest(range(0, len(x) // 2, 500)) AS base, x FROM texts),
blocks AS (SELECT doc_id, base, substr(x, 2 * base + 1, 1198) AS b FROM pieces),
starts AS (SELECT doc_id, base, b, unnest(range(0, least(500, len(b) // 2 - 99))) AS i FROM blocks),
marked AS (
  SELECT doc_id, base + i AS p, row_number() OVER (PARTITION BY substr(b, 2 * i + 1, 200) ORDER BY doc_id, base + i) > 1 AS again FROM starts),
ordered AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM marked WHERE again),
runs AS (SELECT *, sum(CASE WHEN p <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM ordered),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM runs GROUP BY doc_id, run),
cuts AS (
  SELECT doc_id, count(*) AS n, sum(b - a) AS removed, list_concat([0], list(b ORDER BY a)) AS begins, list(a ORDER BY a) AS ends FROM spans GROUP BY doc_id)
SELECT t.doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN x ELSE array_to_string(list_transform(range(1, n + 2),
    lambda k: substr(x, 2 * begins[k] + 1, 2 * (coalesce(ends[k], len(x) // 2) - begins[k]))), '') END)) AS kept_sha256
FROM texts t LEFT JOIN cuts c ON t.doc_id = c.doc_id""",
    "op13_conversation_repair": rf"""
WITH RECURSIVE {CRC_TABLE},
turns AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {CRC.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS fate FROM conversations, crc),
harmed AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM turns WHERE fate <> 0),
sorted AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(role || ':' || text), copy) AS i FROM harmed),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 't' ELSE 'n' END AS fault, role[1:1] AS c,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair, count(*) OVER (PARTITION BY conv_id) AS n FROM sorted),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, list({{'r': role, 't': text}} ORDER BY i) AS said FROM faults GROUP BY conv_id),
best AS (
  SELECT conv_id, max(n) + 1 AS i, '00000000' AS s0, '00000004II' AS s1, '00000002I' AS s2, '00000000' AS s3 FROM faults GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, least(b0, {_sql_edit("u", "2", "I")}), least(b1, {_sql_edit("u", "2", "I")}), u, least(b3, {_sql_edit("b2", "2", "I")})
  FROM (
    SELECT *, least(b2, {_sql_edit("b3", "2", "I")}) AS u FROM (
      SELECT conv_id, i, {_sql_state("s0", [("s", "s1"), ("u", "s2")], "s2")} AS b0, {_sql_state("s1", [("u", "s2")], "s2")} AS b1,
        {_sql_state("s2", [("a", "s3")], "s3")} AS b2, {_sql_state("s3", [("u", "s2")], "s2")} AS b3
      FROM (SELECT b.conv_id, f.i, s0, s1, s2, s3, f.c, f.fault NOT IN ('b', 'd') AS ok, CAST(f.fault = 't' AS INT) AS t
            FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i - 1)))),
audits AS (SELECT conv_id, CAST(s0[:8] AS BIGINT) AS cost, s0[9:] AS audit FROM best WHERE i = 1),
applied AS (
  SELECT a.conv_id, audit, 1 AS k, 1 AS pos, '' AS last, [] :: VARCHAR[] AS kept, said FROM audits a JOIN facts f ON a.conv_id IS NOT DISTINCT FROM f.conv_id
  UNION ALL
  SELECT conv_id, audit, k + 1, pos + CAST(e <> 'I' AS INT), CASE e WHEN 'D' THEN last WHEN 'K' THEN said[pos].r[1:1] ELSE want END,
    CASE e WHEN 'D' THEN kept WHEN 'K' THEN list_append(kept, said[pos].r || ':' || said[pos].t)
      ELSE list_append(kept, CASE want WHEN 'u' THEN 'user:' ELSE 'assistant:' END || CASE e WHEN 'R' THEN said[pos].t ELSE '' END) END, said
  FROM (SELECT *, audit[k:k] AS e, CASE last WHEN 'u' THEN 'a' ELSE 'u' END AS want FROM applied WHERE k <= length(audit))),
ends AS (SELECT conv_id, sha256(array_to_string(kept, chr(10))) AS repaired_sha256 FROM applied WHERE k = length(audit) + 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN audits a ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN ends e ON c.conv_id IS NOT DISTINCT FROM e.conv_id""",
    "op1_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op8_minhash_dedup": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
members AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM members a JOIN members b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * n >= 75 * (len(p.s) + len(q.s) - n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)""",
    "op10_line_dedup": r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM split),
solid AS (SELECT * FROM lines WHERE trim(translate(line, chr(9) || chr(13) || chr(12) || chr(11), '    ')) <> ''),
firsts AS (SELECT line, min(struct_pack(d := doc_id, l := line_no)) AS first, len(line) AS n FROM solid GROUP BY line),
halves AS (
  SELECT line, first, m, 'p' AS side, substring(line, 1, m // 2) AS half FROM firsts, (SELECT unnest([0, 1]) AS k), LATERAL (SELECT n - k AS m)
  UNION ALL
  SELECT line, first, m, 's', substring(line, n - (m - m // 2) + 1) FROM firsts, (SELECT unnest([0, 1]) AS k), LATERAL (SELECT n - k AS m)),
pairs AS (
  SELECT DISTINCT a.line, b.line AS other, b.first FROM halves a JOIN halves b USING (m, side, half) WHERE b.first < a.first),
-- The function counts bytes: a character changed for another of up to four bytes is looked at by characters.
edits AS (SELECT *, levenshtein(line, other) AS bytes, CASE WHEN len(line) > len(other) THEN line ELSE other END AS long, CASE WHEN len(line) > len(other) THEN other ELSE line END AS short
  FROM pairs WHERE abs(len(line) - len(other)) <= 1),
near AS (
  SELECT line, min(first) AS witness FROM edits
  WHERE CASE WHEN bytes <= 1 THEN true WHEN bytes > 4 THEN false
    WHEN len(line) = len(other) THEN len(list_filter(range(1, len(line) + 1), lambda i: line[i] <> other[i])) = 1
    ELSE list_contains(list_transform(range(1, len(long) + 1), lambda i: long[:i - 1] || long[i + 1:]), short) END
  GROUP BY line)
SELECT doc_id, line_no, witness IS NULL AND first.d = doc_id AND first.l = line_no AS kept, coalesce(witness, first).d AS keep_doc_id,
       coalesce(witness, first).l AS keep_line_no, CAST(witness IS NOT NULL AS BIGINT) AS edits
FROM solid JOIN firsts USING (line) LEFT JOIN near USING (line)""",
    "op2_chat_format": """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, regexp_replace(text, '(\\\\)', '\\1\\1', 'g') AS doubled FROM turns),
escaped AS (
  SELECT *, regexp_replace(doubled, '(<)(s>|/s>|<SYS>>|</SYS>>|\\|im_start\\|>|\\|im_end\\|>|\\|endoftext\\|>)|(\\[)(INST\\]|/INST\\])', '\\1\\3' || chr(92) || chr(92) || '\\2\\4', 'g') AS safe FROM sized)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(safe) + 8) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id""",
}
