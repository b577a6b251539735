"""Registered queries of the corpus operators (production parameters, whole tables) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import decontaminate, embeddings, exact_dedup, html_text, katz, language, merkle, packing, quality, simhash, spelling, token_files, \
    warc
from strataflow.llm.common import remainder, ship, table
from strataflow.session import scratch_path


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.score_corpus(table(spark, sf_dir, "documents"), held_out=remainder("doc_id", 10) == 0)
    return scored.withColumnRenamed("id", "doc_id")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_pieces(table(spark, sf_dir, "documents"), vocabulary_file(), end_id=0, capacity=2048)
    return packing.pack(pieces, capacity=2048)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crf = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, crf)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    n_hit = F.size(decontaminate.hit_positions()).cast("long")
    return hits.select(F.col("id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), limit=0.9)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, k=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc.resolve_revisits(warc.assemble(warc.read_archives(spark, folder))).drop("url")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token_files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary_file(), end_id=1)
    return token_files.read_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs)
    found = language.predict(docs.select("doc_id", "text"), model, score_out="score")
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), least_length=6, least_count=5, ratio=5, divisor=199)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), fields=("doc_id", "source", "lang", "n_chars", "text"), group="lang")


def _with_package(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(ship(spark), sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _with_package(f) for f in (
        op1_katz, op2_html_text, op3_best_fit_packing, op4_quality, op5_decontamination, op6_embeddings, op7_simhash, op8_warc, op9_token_files,
        op10_language_id, op11_spelling_variants, op12_exact_dedup, op13_merkle_manifest)
}

#: The 256 steps of CRC-32 as a table ``crc(steps)``, from its polynomial (a fixed value).
_CRC_TABLE = """crc as (select list(s order by i) steps from (
  select i, list_reduce([i] || [0 for k in range(8)], lambda a, x: case when a & 1 = 1 then xor(3988292384, a >> 1) else a >> 1 end) s
  from (select unnest(range(256)) i)))"""


def _crc32(text: str) -> str:
    """crc32 of a text's UTF-8 bytes as DuckDB SQL; the rows it reads are joined with ``crc``."""
    return f"""xor(4294967295, list_reduce([4294967295] || [('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::bigint for k in range(strlen({text}))],
  lambda a, b: xor(steps[(xor(a, b) & 255) + 1], a >> 8)))"""


def _merkle_field(c: str) -> str:
    return f"coalesce(strlen(({c})::varchar) || ':' || ({c})::varchar, '-')"


SQL: dict[str, str] = {
    "op5_decontamination": r"""
with w as (select doc_id, rid, coalesce(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) ws
           from (select doc_id, text, row_number() over () rid from documents)),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from benchmark),
bw as (select distinct item_id, m, array_to_string(ws[i:i + m - 1], ' ') win
       from (select item_id, ws, least(len(ws), 10) m, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) i from b where len(ws) > 0)),
dw as (select rid, m, i, array_to_string(ws[i:i + m - 1], ' ') win
       from (select rid, ws, m, unnest(range(1, len(ws) - m + 2)) i from w, (select distinct m from bw))),
h as (select dw.rid, dw.i, dw.m, bw.item_id from dw join bw using (win)),
c as (select rid, count(distinct p) n_hit from (select distinct rid, unnest(range(i, i + m)) p from h) group by 1),
t as (select rid, count(*) n_items, string_agg(s, ',' order by s) ids from (select distinct rid, item_id::varchar s from h) where s is not null group by 1)
select doc_id, len(ws)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from w left join c using (rid) left join t using (rid)
""",
    "op6_embeddings": """
with recursive v as (select row_number() over () rid, vec_id, embedding::double[] e from embeddings),
ok as (select * from v where len(e) > 0 and list_bool_and([x is not null and isfinite(x) for x in e]) and list_bool_or([x <> 0 for x in e])),
l as (select a.rid x, b.rid y from ok a join ok b on a.rid <> b.rid and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.9),
reach(x, y) as (select rid, rid from v union select r.x, l.y from reach r join l on l.x = r.y),
c as (select r.x, min(v.vec_id) component_id from reach r join v on v.rid = r.y group by r.x)
select v.vec_id, (select count(*) from l where l.x = v.rid) n_links, component_id, coalesce(v.vec_id = component_id, false) kept
from v join c on c.x = v.rid
""",
    "op8_warc": """
with h as (select page_id, strlen(coalesce(html, '')) n, sha1(coalesce(html, '')) d,
                  row_number() over w k, first_value(page_id) over w f
           from pages window w as (partition by coalesce(html, '') order by page_id nulls last, url nulls first)),
b as (select *, [('0x' || substr(d, 5 * i + 1, 5))::bigint for i in range(8)] parts from h)
select page_id, n payload_bytes,
       array_to_string(flatten([[substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((p >> s) & 31) + 1, 1) for s in [15, 10, 5, 0]] for p in parts]), '')
         payload_digest,
       case when k = 1 then 'response' else 'revisit' end record_type, case when k > 1 then f end refers_to
from b
""",
    "op11_spelling_variants": rf"""
with recursive {_CRC_TABLE},
runs as (select coalesce(doc_id::varchar, '') doc, r, count(*) c
         from (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[a-z\x{{C0}}-\x{{FF}}]+')) r from documents) group by all),
hashed as (select r, c, {_crc32("doc || ':' || r")} h from runs, crc where length(r) >= 6),
w as (select word, sum(c)::bigint n
      from (select c, case when h % 199 = 0 then r[:(h % length(r))] || r[(h % length(r)) + 2:] else r end word from hashed)
      where length(word) >= 6 group by 1 having sum(c) >= 5),
cut as (select word, i, word[:i] || word[i + 2:] rest from (select word, unnest(range(length(word))) i from w)),
near as (select distinct a, b from (
  select x.word a, y.word b from cut x join cut y using (i, rest) where x.word <> y.word and length(x.word) = length(y.word)
  union all select word, rest from cut where rest in (select word from w)
  union all select rest, word from cut where rest in (select word from w))),
best as (select a, count(*) k, arg_min(b, (-m.n, m.word)) b, max(m.n) top from near join w m on m.word = b group by a),
f as (select word, n, coalesce(k, 0)::bigint n_near, case when top >= 5 * n then b end form, case when top >= 5 * n then top end form_n
      from w left join best on a = word),
chain(word, top, step) as (select word, word, 0 from f union all select chain.word, f.form, step + 1 from chain join f on f.word = chain.top where f.form is not null),
root as (select word, arg_max(top, step) root from chain group by 1)
select f.word, form, root, n, n_near, form_n from f join root using (word)
""",
    "op12_exact_dedup": """
with d as (select doc_id, coalesce(text, '') t, row_number() over () rid from documents),
k as (select *, max(doc_id) over (partition by t) keep_id, count(*) over (partition by t) n,
             row_number() over (partition by t order by doc_id desc nulls last, rid) place from d)
select doc_id, keep_id, n group_size, place = 1 kept, sha256(t) text_sha256 from k
""",
    "op13_merkle_manifest": f"""
with recursive {_CRC_TABLE},
r as (select row_number() over () rid, *, coalesce(doc_id::varchar, '') id from documents),
v as (select rid, doc_id, lang, {_crc32("id")} % 3 = 0 spoilt, text,
             concat({", ".join(_merkle_field(c) for c in ("doc_id", "source", "lang", "n_chars"))}) head from r, crc),
h as (select *, sha256(head || {_merkle_field("text")}) leaf,
             sha256(head || case when spoilt then {_merkle_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                            else {_merkle_field("text")} end) tampered from v),
l as (select *, dense_rank() over (order by lang nulls first) - 1 g, row_number() over (partition by lang order by doc_id nulls first, leaf, rid) - 1 idx,
             count(*) over (partition by lang) n from h),
inner_nodes(g, level, n, idx, hash) as (
  select g, 0, n, idx, leaf from l
  union all select g, level + 1, (n + 7) // 8, idx // 8, sha256(string_agg(hash, '' order by idx)) from inner_nodes where n > 1 group by g, level, n, idx // 8),
sub as (select g, hash, count(*) over () k from inner_nodes where n = 1),
top_nodes(g, level, n, idx, hash) as (
  select -1, 0, k, g, hash from sub
  union all select g, level + 1, (n + 7) // 8, idx // 8, sha256(string_agg(hash, '' order by idx)) from top_nodes where n > 1 group by g, level, n, idx // 8),
nodes as (select * from inner_nodes union all select * from top_nodes),
runs as (select g, level, n, idx // 8 up, list(hash order by idx) kids from nodes where n > 1 group by all),
climb(rid, g, level, idx, hash, proof, own) as (
  select rid, g, 0, idx, tampered, '', g from l
  union all
  select c.rid, case when r.up is not null then c.g else -1 end, case when r.up is not null then c.level + 1 else 0 end,
         case when r.up is not null then c.idx // 8 else c.own end,
         case when r.up is not null then sha256(array_to_string(kids[:c.idx % 8] || [c.hash] || kids[c.idx % 8 + 2:], '')) else c.hash end,
         case when r.up is not null then c.proof || array_to_string(kids[:c.idx % 8] || kids[c.idx % 8 + 2:], '') else c.proof end, c.own
  from climb c left join runs r on r.g = c.g and r.level = c.level and r.up = c.idx // 8
  where r.up is not null or c.g >= 0),
done as (select rid, arg_max(hash, (case when g < 0 then 1 else 0 end, level)) folded, arg_max(proof, (case when g < 0 then 1 else 0 end, level)) proof
         from climb group by rid)
select doc_id, leaf, sub.hash subroot, top.hash root, sha256(proof) proof_sha256, folded folded_root, folded = top.hash verified
from l join sub using (g) join done using (rid), (select hash from top_nodes where n = 1) top
""",
}
