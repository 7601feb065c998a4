"""The registered queries of this subpackage over the driver tables, and the SQL that checks them."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlens.llm import bpe, decontaminate, lattice, lines, manifest, records, secrets, simhash, suffixes, toxicity
from quorumlens.llm import tries, urls, vectors
from quorumlens.llm.common import settled, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_toxicity")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's toxicity, learnt from the labelled rows outside the held-out fifth."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op2_secrets")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's secrets: fixed forms and spans of high entropy."""
    found = secrets.scan(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda x: x["order"] < len(secrets.FORMS))
    count = lambda k: F.size(F.filter("secrets", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(form[0]).alias(f"n_{form[0]}") for form in secrets.FORMS),
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("secrets")).alias("spans"),
    )


@query("op3_bpe_round_trip")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    """Every document encoded by chunk reuse and decoded again."""
    path = tokenizer("byte_bpe_50k.json")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encode, _ = bpe.encoder(docs, path)
    decode = bpe.decoder(path)

    def digest(batches):
        for batch in decode(encode(batches)):
            n, ids, text = [], [], []
            for i, t in zip(batch.column(2), batch.column(3).to_pylist()):
                raw = i.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False).tobytes()
                n.append(len(raw) // 4)
                ids.append(hashlib.sha256(raw).hexdigest())
                text.append(hashlib.sha256(t.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op4_vector_dedup")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    return vectors.near_duplicates(table(spark, sf, "embeddings"))


_SHINGLES = r"""
    SELECT {id} AS id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM (SELECT {id}, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w FROM {table})
"""


@query(
    "op5_decontamination",
    f"""
WITH d AS (SELECT DISTINCT * FROM ({_SHINGLES.format(id="doc_id", table="documents")})),
b AS (SELECT DISTINCT * FROM ({_SHINGLES.format(id="item_id", table="benchmark")})),
size AS (SELECT id, count(*) AS n FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared, any_value(size.n) AS item_shingles
FROM d JOIN b ON d.s = b.s JOIN size ON size.id = b.id
GROUP BY d.id, b.id HAVING count(*) >= 0.8 * any_value(size.n) - 1e-9
""",
)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    """Every test item that a document contains at 0.8 or more of its five-word shingles."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.search(docs, table(spark, sf, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", "m.item_id", F.col("m.shared").cast("long").alias("shared"), F.col("m.of").cast("long").alias("item_shingles")
    )


@query("op6_token_records")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """Every document written as a token record, and what the files then hold."""
    folder = records.write_records(
        table(spark, sf, "documents"), shared_folder(spark, "records"), tokenizer("word_bpe_49k.json"), end_id=1
    )

    def digest(batches):
        for batch in records.scanner(batches):
            crc = [
                zlib.crc32(ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
                for ids in batch.column(5)
            ]
            keep = [batch.column(i) for i in (0, 1, 3, 4)]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(np.array(crc, np.int64))], ["shard", "position", "doc_id", "n_tokens", "ids_crc32"]
            )

    found = records.files_of(spark, folder).mapInArrow(
        digest, "shard string, position long, doc_id long, n_tokens long, ids_crc32 long"
    )
    index = spark.read.parquet(f"{folder}/index").select("shard", "position", "start")
    return found.join(index, ["shard", "position"]).select("doc_id", "start", "n_tokens", "ids_crc32")


#: Kept lines of ``documents``, after the same rule over plain joins; also the second stage of the pipeline.
LINES_SQL = r"""
lines AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS k,
    unnest(string_split(text, chr(10))) AS line FROM {docs}),
sets AS (SELECT doc_id, k, line,
    list_sort(list_distinct(list_filter(regexp_split_to_array(lower(line), '\s+'), lambda x: x <> ''))) AS w FROM lines),
firsts AS (SELECT w, len(w) AS n, min(struct_pack(d := doc_id, k := k)) AS place FROM sets
    WHERE len(w) > 0 GROUP BY w),
numbered AS (SELECT row_number() OVER (ORDER BY place) AS c, * FROM firsts),
tokens AS (SELECT c, n, unnest(w) AS t FROM numbered),
pairs AS (SELECT x.c AS c, any_value(x.n) + any_value(y.n) AS sizes, count(*) AS shared FROM tokens x JOIN tokens y
    ON x.t = y.t AND y.c < x.c AND least(x.n, y.n) >= 0.8 * greatest(x.n, y.n) - 1e-9 GROUP BY x.c, y.c),
kept AS (SELECT place.d AS doc_id, place.k AS k FROM numbered
    WHERE c NOT IN (SELECT c FROM pairs WHERE shared * 1.8 >= sizes * 0.8 - 1e-9)
    UNION ALL SELECT doc_id, k FROM sets WHERE len(w) = 0),
deduped AS (SELECT s.doc_id, coalesce(string_agg(s.line, chr(10) ORDER BY s.k) FILTER (k.k IS NOT NULL), '') AS text,
    count(*) AS n_lines, count(*) - count(k.k) AS n_removed
    FROM sets s LEFT JOIN kept k ON s.doc_id = k.doc_id AND s.k = k.k GROUP BY s.doc_id)
"""


@query(
    "op7_line_dedup",
    f"WITH {LINES_SQL.format(docs='documents')} SELECT doc_id, n_lines, n_removed, text AS kept_text FROM deduped",
)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the lines that resemble an earlier line at Jaccard 0.8 or more."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "doc_id",
        F.col("n_lines").cast("long"),
        F.col("n_removed").cast("long"),
        F.col("text").alias("kept_text"),
    )


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the 100-byte strings that also start earlier."""
    found = suffixes.dedup_substrings(table(spark, sf, "documents").select("doc_id", "text"))

    def digest(batches):
        for batch in batches:
            size, gone, n, kept = [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                size.append(len((text or "").encode()))
                gone.append(sum(s["end"] - s["begin"] for s in spans))
                n.append(len(spans))
                kept.append(hashlib.sha256(suffixes.kept_bytes(text, spans)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (size, gone, n)), pa.array(kept)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return found.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _urls_sql() -> str:
    rule, verdict = "NULL", "NULL"
    for says, host, path in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        rule = f"CASE WHEN {fits} THEN '{host}{path}' ELSE {rule} END"
        verdict = f"CASE WHEN {fits} THEN '{says}' ELSE {verdict} END"
    k = urls.ORDER
    steps = [f"f AS (SELECT gram, {1 / urls.ALPHABET!r} AS y, {1 / urls.ALPHABET!r} AS n FROM grams)"]
    name = "f"
    for o in range(k + 1):
        steps += [
            f"j{o} AS (SELECT substr(gram, {k + 1 - o}, {o + 1}) AS tail, sum(y) AS y, sum(n) AS n FROM seen GROUP BY 1)",
            f"c{o} AS (SELECT substr(tail, 1, {o}) AS context, sum(y) AS y, sum(n) AS n FROM j{o} GROUP BY 1)",
            f"""f{o} AS (SELECT gram, (coalesce(j.y, 0) + {urls.SMOOTH} * f.y) / (coalesce(c.y, 0) + {urls.SMOOTH}) AS y,
                (coalesce(j.n, 0) + {urls.SMOOTH} * f.n) / (coalesce(c.n, 0) + {urls.SMOOTH}) AS n
                FROM {name} f LEFT JOIN j{o} j ON j.tail = substr(gram, {k + 1 - o}, {o + 1})
                LEFT JOIN c{o} c ON c.context = substr(gram, {k + 1 - o}, {o}))""",
        ]
        name = f"f{o}"
    return rf"""
WITH split AS (SELECT page_id,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (SELECT *, {rule} AS rule, {verdict} AS by_rule FROM split),
texts AS (SELECT host, path, by_rule, host || path AS text, count(*) AS n,
    instr('0123456789abcdef', md5(host || path)[1]) % {urls.FOLDS} AS fold FROM ruled GROUP BY host, path, by_rule),
chars AS (SELECT host, path, by_rule, n, fold, unnest(list_transform(range(1, length(text) + 1),
    lambda i: substr(repeat(chr(2), {k}) || text, i, {k + 1}))) AS gram FROM texts),
seen AS (SELECT gram, sum(CASE WHEN by_rule = 'allow' THEN n ELSE 0 END) AS y,
    sum(CASE WHEN by_rule = 'block' THEN n ELSE 0 END) AS n FROM chars
    WHERE by_rule IS NOT NULL AND fold <> 0 GROUP BY gram),
grams AS (SELECT DISTINCT gram FROM chars),
{", ".join(steps)},
means AS (SELECT host, path, round(sum(ln(f.y) - ln(f.n)) / count(*), 6) AS score
    FROM chars JOIN {name} f USING (gram) GROUP BY host, path),
scored AS (SELECT t.*, coalesce(m.score, 0) AS score FROM texts t LEFT JOIN means m USING (host, path)),
grid AS (SELECT floor(score * 1000) AS step, sum(CASE WHEN by_rule = 'allow' THEN n ELSE 0 END) AS y,
    sum(CASE WHEN by_rule = 'block' THEN n ELSE 0 END) AS n FROM scored WHERE by_rule IS NOT NULL AND fold = 0 GROUP BY 1),
wrong AS (SELECT step, round(coalesce(sum(y) OVER w, 0) / (SELECT sum(y)::DOUBLE FROM grid) + 1
    - coalesce(sum(n) OVER w, 0) / (SELECT sum(n)::DOUBLE FROM grid), 9) AS lost
    FROM grid WINDOW w AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT coalesce((SELECT step / 1000 AS at_least FROM wrong WHERE (SELECT sum(y) > 0 AND sum(n) > 0 FROM grid)
    ORDER BY lost, step LIMIT 1), 0) AS least_score)
SELECT r.page_id, r.host, r.path, r.rule,
    coalesce(r.by_rule, CASE WHEN s.score >= (SELECT least_score FROM cut) THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled r JOIN scored s USING (host, path)
"""


@query("op9_url_filter", _urls_sql())
def op9(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's url judged by rules and, beyond them, by the ratio of character models."""
    found = urls.judge(table(spark, sf, "pages").select("page_id", "url"), RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


@query("op10_simhash")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    """SimHash components of all documents at four bits over four-word shingles."""
    found = simhash.near_duplicates(table(spark, sf, "documents"), words=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def _crc(text: str) -> str:
    """SQL for the unsigned crc32 of a string of decimal digits."""
    step = "lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::UBIGINT)"
    folded = f"lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)::UBIGINT[]), {step})"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], {codes}), {folded}), 4294967295::UBIGINT)::BIGINT"


@query("op11_language_model")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's log10 probability over all segmentations, learnt outside the held-out seventh."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    docs = table(spark, sf, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return lattice.score_corpus(docs, tokenizer("piece_bpe_32k.model"), ~F.col("held_out"), ["doc_id", "held_out"])


def _manifest_sql(levels: int = 8) -> str:
    """Nodes and proofs level by level; ``levels`` levels hold 16 ** levels rows of a source."""
    enc = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(map(enc, ["doc_id", "source", "lang", "n_chars", text])) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(n: str, rows: str) -> str:
        """Levels {n}0.. (tree, node, digest, size: nodes of the level), runs {n}r0.. and {n}last, the last nodes."""
        out = [f"{n}0 AS (SELECT tree, idx AS node, digest, count(*) OVER (PARTITION BY tree) AS size FROM {rows})"]
        for k in range(levels):
            out += [
                f"""{n}r{k} AS (SELECT tree, node // 16 AS node, list(digest ORDER BY node) AS run,
                    (any_value(size) + 15) // 16 AS size FROM {n}{k} WHERE size > 1 GROUP BY tree, node // 16)""",
                f"{n}{k + 1} AS (SELECT tree, node, sha256(array_to_string(run, '')) AS digest, size FROM {n}r{k})",
            ]
        last = " UNION ALL ".join(f"SELECT tree, digest FROM {n}{k} WHERE size = 1" for k in range(levels + 1))
        return ", ".join([*out, f"{n}last AS ({last})"])

    def walk(n: str, rows: str, tree: str, idx: str) -> str:
        """Steps of ``cur`` and ``proof`` through the runs of a tree."""
        out, last = [], rows
        for k in range(levels):
            at = f"w.{idx} // {16**k} % 16"
            left, right = f"array_to_string(r.run[1:{at}], '')", f"array_to_string(r.run[{at} + 2:], '')"
            out.append(
                f"""{n}w{k} AS (SELECT w.* REPLACE (
                    CASE WHEN r.run IS NULL THEN cur ELSE sha256({left} || cur || {right}) END AS cur,
                    CASE WHEN r.run IS NULL THEN proof ELSE proof || {left} || {right} END AS proof)
                FROM {last} w LEFT JOIN {n}r{k} r ON r.tree = {tree} AND r.node = w.{idx} // {16 ** (k + 1)})"""
            )
            last = f"{n}w{k}"
        return ", ".join(out)

    return f"""
WITH hashed AS (SELECT doc_id, source, {leaf("text")} AS leaf,
    CASE WHEN {_crc("doc_id::VARCHAR")} % 5 = 0 THEN {leaf(low)} ELSE {leaf("text")} END AS cur FROM documents),
placed AS (SELECT doc_id, leaf, cur, '' AS proof, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM hashed),
leaves AS (SELECT tree, idx, leaf AS digest FROM placed),
{tree("a", "leaves")},
subroots AS (SELECT 0 AS tree, tree AS idx, digest FROM alast),
{tree("b", "subroots")},
{walk("a", "placed", "w.tree", "idx")},
{walk("b", f"aw{levels - 1}", "0", "tree")}
SELECT w.doc_id, w.leaf, s.digest AS subroot, t.digest AS root, sha256(w.proof) AS proof_sha256,
    w.cur AS folded_root, w.cur = t.digest AS verified
FROM bw{levels - 1} w JOIN alast s ON s.tree = w.tree CROSS JOIN blast t
"""


@query("op12_merkle_manifest", _manifest_sql())
def op12(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's leaf and proof, and what they lead to once a fifth of the texts is tampered with."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    tampered = F.when(hit, manifest.leaf_digest(*fields, low))
    made = manifest.build(docs, manifest.leaf_digest(*fields, F.col("text")), "source", "doc_id", {"tampered": tampered})
    root, groups = made.root, made.groups

    def digest(batches):
        for batch in batches:
            proofs, folded = [], []
            at = [batch.schema.get_field_index(c) for c in ("tree", "idx", "size", "digest", "k_tampered", "path")]
            for tree, idx, size, leaf, other, path in zip(*(batch.column(k).to_pylist() for k in at)):
                proofs.append(hashlib.sha256(path.encode()).hexdigest())
                shape = manifest.shape_of(idx, size) + manifest.shape_of(tree, groups)
                folded.append(manifest.fold(other or leaf, path, shape))
            same = batch.schema.get_field_index
            columns = [batch.column(same("id")), batch.column(same("digest")), batch.column(same("note"))]
            columns += [pa.array([root] * len(folded)), pa.array(proofs), pa.array(folded)]
            columns.append(pa.array([f == root for f in folded]))
            names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return manifest.prove(
        made,
        digest,
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )


@query(
    "op13_conversation_trie",
    f"""
WITH own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS donor, {_crc("conv_id::VARCHAR")} % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM own)),
parts AS (SELECT c.conv_id, 0 AS part, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.donor AND o.pos <= c.h
    UNION ALL SELECT c.conv_id, 1, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
whole AS (SELECT c.conv_id, coalesce(list(struct_pack(role := p.role, text := p.text) ORDER BY part, pos)
    FILTER (p.pos IS NOT NULL), []) AS turns FROM convs c LEFT JOIN parts p ON p.conv_id = c.conv_id GROUP BY c.conv_id),
steps AS (SELECT conv_id, unnest(range(len(turns) + 1)) AS depth, turns FROM whole),
paths AS (SELECT conv_id, depth, turns[1:depth] AS path, depth = len(turns) AS ended FROM steps),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends FROM paths GROUP BY path, depth),
kids AS (SELECT path[1:depth - 1] AS above, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
tree AS (SELECT n.*, coalesce(k.n, 0) AS children,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n.n - 1) * length(path[n.depth].text) END AS saved
    FROM nodes n LEFT JOIN kids k ON k.above = n.path),
below AS (SELECT path[1:d] AS top, count(*) FILTER (children = 0) AS leaves, sum(saved) AS saved
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM tree) GROUP BY 1)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n AS n_convs, t.children AS n_children, b.leaves AS n_leaves,
    b.saved::BIGINT AS saved_tokens, t.ends AS ends_sha256
FROM tree t JOIN below b ON b.top = t.path LEFT JOIN nodes p ON t.depth > 0 AND p.path = t.path[1:t.depth - 1]
""",
)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    """The prefix trie of conversations that take up to five first turns of the conversation that opens their hundred."""
    turns = settled(tries.ordered_turns(table(spark, sf, "conversations")), "turns")
    conv = F.col("conv_id")
    return tries.trie(tries.rebuilt(turns, conv - conv % 100, F.crc32(conv.cast("string")) % 6, 5))
