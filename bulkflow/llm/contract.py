"""The registered queries of this package and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.llm import (
    chat_template,
    lang_hyperdim,
    merkle_manifest,
    piecewise_hash,
    pii_transducer,
    poisson_mix,
    quality_llr,
    quality_rff,
    sentencepiece_bpe,
    simhash_ring,
    spelling_variants,
    toxicity_pu,
    window_dedup,
)
from bulkflow.llm.common import held_out, ids_and_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is ($TOKENIZERS_DIR, or the installed package); only the driver reads it."""
    folder = os.environ.get("TOKENIZERS_DIR")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = sentencepiece_bpe.Vocabulary.read(tokenizer_file("piece_bpe_32k.model"))
    texts = ids_and_texts(documents(spark, sf_dir), "doc_id", "text")
    encoded = sentencepiece_bpe.encode_documents(texts, vocabulary)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_ring.near_duplicates(documents(spark, sf_dir), shingle=4, limit=4, segments=5)
    return found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = window_dedup.remove_repeats(documents(spark, sf_dir), size=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity_pu.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), toxicity_pu.score_column(model, docs["text"]).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op3_pii_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_transducer.find_personal_data(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii_transducer.KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query
def op4_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = piecewise_hash.compare_with_next(documents(spark, sf_dir))
    columns = ("fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *columns)


@query
def op7_hyperdim_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = lang_hyperdim.predict_column(lang_hyperdim.learn(docs), docs["text"])
    scored = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), found.alias("found"))
    return scored.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


@query
def op8_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_llr.judge(docs, quality_llr.learn_ratios(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query
def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return poisson_mix.mix(docs, poisson_mix.tempered_weights(docs))


SQL["op9_poisson_mix"] = poisson_mix.mix_sql()


@query
def op10_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality_rff.measure(documents(spark, sf_dir))
    model = quality_rff.fit(measured, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_rff.score_column(model, F.col("stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


#: The columns of a leaf in their order, and the nodes of a run.
LEAF, RUN = ("doc_id", "source", "lang", "n_chars", "text"), 3


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    changed = (F.crc32(docs["doc_id"].cast("string")) % 2 == 0) & F.contains(docs["text"], F.lit("\n"))
    values = [docs[c] if c != "text" else F.replace(docs["text"], F.lit("\n")) for c in LEAF]
    tampered = F.when(changed, merkle_manifest.leaf_digest(values))
    root, proofs = merkle_manifest.manifest(docs, LEAF, "source", "doc_id", RUN, {"tampered": tampered})
    folded = merkle_manifest.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    found = proofs.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(root).cast("string").alias("root"),
        merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc32_sql(codes: str) -> str:
    """DuckDB: the unsigned crc32 of a list of byte values."""
    marked = f"flatten(list_transform({codes}, lambda c: [c::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {marked}), lambda x, y: {step}), 4294967295::BIGINT)"


def _merkle_sql() -> str:
    def leaf(text: str) -> str:
        values = [f"{c}::VARCHAR" for c in LEAF[:-1]] + [text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    crc = _crc32_sql("list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c))")

    def up(name: str, nodes: str) -> str:
        return f"""{name} AS (
  SELECT 0 AS lvl, grp, i, n, h FROM {nodes}
  UNION ALL
  SELECT lvl + 1, grp, i // {RUN}, (n + {RUN - 1}) // {RUN}, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1
  GROUP BY lvl, grp, i // {RUN}, n)"""

    def sides(name: str, nodes: str) -> str:
        run = f"OVER (PARTITION BY lvl, grp, i // {RUN} ORDER BY i ROWS BETWEEN"
        return f"""{name} AS (SELECT lvl, grp, i, n,
  coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {nodes})"""

    def fold(name: str, first: str, sides_: str) -> str:
        return f"""{name} AS (
  {first}
  UNION ALL
  SELECT f.id, f.lvl + 1, f.grp, f.i // {RUN}, sha256(s.before || f.acc || s.after), f.proof || s.before || s.after
  FROM {name} f JOIN {sides_} s ON s.lvl = f.lvl AND s.grp = f.grp AND s.i = f.i WHERE s.n > 1)"""

    return f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, {leaf("text")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS given FROM documents),
leaves AS (
  SELECT row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS id, doc_id, leaf, given, leaf AS h,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM rows_),
{up("low", "leaves")},
groups_ AS (SELECT 0 AS grp, grp AS i, count(*) OVER () AS n, h FROM low WHERE n = 1),
{up("high", "groups_")},
{sides("low_sides", "low")},
{sides("high_sides", "high")},
{fold("low_fold", "SELECT id, 0 AS lvl, grp, i, given AS acc, '' AS proof FROM leaves", "low_sides")},
reached AS (SELECT f.* FROM low_fold f JOIN low_sides s ON s.lvl = f.lvl AND s.grp = f.grp AND s.i = f.i WHERE s.n = 1),
{fold("high_fold", "SELECT id, 0 AS lvl, 0 AS grp, grp AS i, acc, proof FROM reached", "high_sides")},
ended AS (SELECT f.* FROM high_fold f JOIN high_sides s ON s.lvl = f.lvl AND s.grp = f.grp AND s.i = f.i WHERE s.n = 1)
SELECT l.doc_id, l.leaf, g.h AS subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.acc AS folded_root, e.acc = t.h AS verified
FROM leaves l JOIN ended e ON e.id = l.id JOIN groups_ g ON g.i = l.grp JOIN (SELECT h FROM high WHERE n = 1) t ON true
"""


SQL["op11_merkle_manifest"] = _merkle_sql()


#: One run in so many is spoilt, the least occurrences of a word, and how much more often a form occurs.
SPOIL, LEAST, RATIO = 199, 5, 5


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.words_of(documents(spark, sf_dir), spelling_variants.SHORTEST, spoil=SPOIL)
    return spelling_variants.forms(spelling_variants.vocabulary(words, LEAST), RATIO)


def _spelling_sql() -> str:
    name = "coalesce(doc_id::VARCHAR, '') || ':' || run"
    crc = _crc32_sql(f"list_transform(range(strlen({name})), lambda k: ('0x' || substr(hex({name}), 2 * k::INT + 1, 2))::INT)")
    least, run = spelling_variants.SHORTEST, spelling_variants.RUN
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{spelling_variants.UPPER}', '{spelling_variants.LOWER}'), '{run}')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= {least} GROUP BY ALL),
hashed AS (SELECT run, n, {crc} AS h FROM counted),
spoilt AS (SELECT CASE WHEN h % {SPOIL} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spoilt WHERE length(word) >= {least} GROUP BY word HAVING sum(n) >= {LEAST}),
cuts AS (SELECT word, n, place, substr(word, 1, place) || substr(word, place + 2) AS cut FROM (SELECT word, n, unnest(range(length(word)))::INT AS place FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.place = b.place AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
chosen AS (SELECT b.word, b.n_near, b.most, min(x.other) AS other FROM best b JOIN near x ON x.word = b.word AND x.n = b.most GROUP BY ALL),
formed AS (SELECT w.word, CASE WHEN c.most >= {RATIO} * w.n THEN c.other END AS form, w.n, coalesce(c.n_near, 0) AS n_near,
  CASE WHEN c.most >= {RATIO} * w.n THEN c.most END AS form_n FROM words w LEFT JOIN chosen c ON c.word = w.word),
chain AS (SELECT word, word AS root, form FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.form)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""


SQL["op12_spelling_variants"] = _spelling_sql()

#: A chat format: its control strings, its template, and a turn as it is read back.
CONTROLS = ("<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]")
CHAT = """\
<s>
{%- for message in messages -%}
  [ROLE]{{ message.role | protect }}[/ROLE]
  {%- if message.role == 'assistant' -%}
    {%- generation -%}{{ message.text | protect }}{%- endgeneration -%}</s>
  {%- else -%}
    [INST]{{ message.text | protect }}[/INST]
  {%- endif -%}
{%- endfor -%}
</s>"""
TURN = re.compile(r"\[ROLE\](?P<role>.*?)\[/ROLE\](?:\[INST\])?(?P<text>.*?)(?:\[/INST\]|</s>)", re.DOTALL)

#: The conversation that the contract adds.
ADDED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query
def op13_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame(ADDED, rows.schema))
    template = chat_template.Template(CHAT, CONTROLS)
    pieces = chat_template.format_conversations(rows, template, "conv_id", "turn", ("role", "text"))
    return chat_template.read_back(pieces, TURN, template).withColumnRenamed("conversation", "conv_id")


def _chat_sql() -> str:
    added = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in ADDED)
    control = r"<\\*/?s>|\[\\*/?(?:ROLE|INST)\]"

    def escaped(column: str) -> str:
        return f"length({column}) + len(regexp_extract_all({column}, '{control}'))"

    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES {added}) AS t(conv_id, turn, role, text)))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum({escaped("role")} + {escaped("text")} + CASE role WHEN 'assistant' THEN 17 ELSE 26 END) + 7)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


SQL["op13_chat_template"] = _chat_sql()
