"""The registered queries of this subpackage, and their SQL where SQL can
express them.  Each one applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm import arc_convert, conversation_repair, decontaminate, language_id, line_dedup, lm_scoring, mixing, mtree, near_dup, phrases, quality_mil, substring_dedup, token_files
from wardstat.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str = "doc_id"):
    """True for the quarter of ids that no model may learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def label_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a sampling weight from their quality label: 1.0 for
    good, 0.25 for bad, 0.7 without a label."""
    one = labels.groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    joined = docs.join(one, "doc_id", "left")
    return joined.withColumn("_weight", F.expr("case _quality when 1 then 1.0D when 0 then 0.25D else 0.7D end")).drop("_quality")


def op1_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("n"))
    docs = label_weights(docs, table(spark, sf_dir, "labels"))
    mixed = mixing.mix_sizes(docs, F.col("n"), F.col("_weight"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP1_SQL = r"""
with sized as (
  select d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    -ln((('0x' || substr(md5('mix' || coalesce(d.doc_id::varchar, 'null')), 1, 13))::bigint + 0.5) / 4503599627370496.0)
      / (case l.quality when 1 then 1.0::double when 0 then 0.25::double else 0.7::double end) as key
  from documents d left join (select doc_id, max(quality) as quality from labels group by doc_id) l on d.doc_id = l.doc_id
), src as (
  select source, sum(size)::hugeint as source_size, (row_number() over (order by source asc nulls last) - 1) % 3 + 1 as w
  from sized group by source
), fill as (
  select *, source_size * 3 as cap,
    sum(source_size) over () - coalesce(sum(source_size * 3) over (order by source_size * 3 / w::double, source nulls last
      rows between unbounded preceding and 1 preceding), 0) as left_over,
    sum(w) over (order by source_size * 3 / w::double, source nulls last rows between current row and unbounded following) as w_left
  from src
), level as (
  select (left_over)::hugeint as left_over, w_left from fill where cap * w_left > w * left_over
  order by cap / w::double, source nulls last limit 1
), plan as (
  select f.source, f.source_size, case when f.cap * f.w_left <= f.w * f.left_over then f.cap::double
    else (f.w * l.left_over)::double / l.w_left::double end as target
  from fill f left join level l on true
), run as (
  select s.doc_id, s.size, p.source_size, p.target,
    case when p.source_size > 0 then floor(p.target / p.source_size::double) else 0 end as epochs,
    sum(s.size) over (partition by s.source order by s.key, s.doc_id rows between unbounded preceding and current row) as cum
  from sized s join plan p on s.source is not distinct from p.source
)
select doc_id, size, source_size::bigint as source_size, target,
  (size * (epochs::bigint + case when size > 0 and target - epochs * source_size::double > 0
    and 2 * cum - size < 2 * (target - epochs * source_size::double) then 1 else 0 end))::bigint as taken
from run
"""


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.stupid_backoff(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(~held_out()))
    found = language_id.predict(docs.drop("lang"), model, keep=("doc_id",))
    # the contract asks for a learned language wherever there is a letter
    return found.select("doc_id", held_out().alias("held_out"), F.col("lang_best").alias("lang_pred"), "score")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", mtree.quantised().alias("v"))
    return mtree.top_k(rows, F.col("vec_id") % 50 == 0, 5)


OP4_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)
)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
) where rank <= 5
"""


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.overlaps(docs, items, keep=("doc_id",))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_mil.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    scored = quality_mil.score(docs, model, drop_text=True)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document with a line that is not blank: how many of them, how many
    stay, and their positions."""
    found = line_dedup.duplicate_lines(table(spark, sf_dir, "documents"))
    stay = F.sort_array(F.collect_set(F.when(F.col("kept"), F.col("pos"))))
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("kept").alias("n_kept"), stay.alias("kept_positions"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = scratch_path(spark, "token-blocks")
    token_files.write_blocks(docs, path, tokenizer_file())
    return token_files.read_documents(spark.read.parquet(path))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, table(spark, sf_dir, "documents"))


def op11_conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.audit(conversation_repair.damaged(rows), rows)


OP11_SQL = r"""
with recursive hit as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, xor(4294967295, list_reduce(
    list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ord(c)::bigint),
    lambda acc, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384), xor(acc, b)),
    4294967295::bigint)) % 20 as kind
  from conversations
), harmed as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from hit where kind <> 0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as pos from harmed
), judged as (
  select conv_id, pos, turn, role, text, left(role, 1) as i,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
      when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault,
    left(role, 1) || left(lead(role) over (partition by conv_id order by pos), 1) as pair
  from placed
), counted as (
  select conv_id,
    coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
    count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where pair is not null and pair not in ('su', 'ua', 'au')) as illegal, max(pos) as n
  from judged group by conv_id
), before(s, t, price, edits, lines) as (values
  (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 5, 'I', e'user:\n'), (1, 2, 5, 'I', e'user:\n'), (2, 3, 5, 'I', e'assistant:\n'), (3, 2, 5, 'I', e'user:\n'),
  (0, 3, 10, 'II', e'user:\nassistant:\n'), (1, 3, 10, 'II', e'user:\nassistant:\n'),
  (2, 2, 10, 'II', e'assistant:\nuser:\n'), (3, 3, 10, 'II', e'user:\nassistant:\n')
), edit(i, s, t, price, edit) as (values
  ('', 0, 0, 2, 'D'), ('', 1, 1, 2, 'D'), ('', 2, 2, 2, 'D'), ('', 3, 3, 2, 'D'),
  ('s', 0, 1, 0, 'K'), ('u', 0, 2, 0, 'K'), ('u', 1, 2, 0, 'K'), ('u', 3, 2, 0, 'K'), ('a', 2, 3, 0, 'K'),
  ('', 0, 2, 1, 'R'), ('', 1, 2, 1, 'R'), ('', 3, 2, 1, 'R'), ('', 2, 3, 1, 'R')
), walk as (
  select conv_id, 0::bigint as pos, 0 as s, {'cost': 0::bigint, 'audit': '', 'lines': ''} as best from counted
  union all
  select w.conv_id, j.pos, e.t, min({'cost': w.best.cost + b.price + e.price + case when e.edit <> 'D' and j.fault = 'truncated' then 5 else 0 end,
    'audit': w.best.audit || b.edits || e.edit,
    'lines': w.best.lines || b.lines || case e.edit when 'D' then '' when 'K' then j.role || ':' || j.text || chr(10)
      else case when b.t = 2 then 'assistant:' else 'user:' end || j.text || chr(10) end})
  from walk w join judged j on j.conv_id is not distinct from w.conv_id and j.pos = w.pos + 1
    join before b on b.s = w.s join edit e on e.s = b.t and (e.i = '' or e.i = j.i) and (e.edit = 'D' or j.fault not in ('blank', 'duplicate'))
  group by w.conv_id, j.pos, e.t
), ended as (
  select w.conv_id, min({'cost': w.best.cost + case w.s when 1 then 10 when 2 then 5 else 0 end,
    'audit': w.best.audit || case w.s when 1 then 'II' when 2 then 'I' else '' end,
    'lines': w.best.lines || case w.s when 1 then e'user:\nassistant:\n' when 2 then e'assistant:\n' else '' end}) as best
  from walk w join counted c on c.conv_id is not distinct from w.conv_id and c.n = w.pos group by w.conv_id
)
select o.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
  coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, coalesce(e.best.cost, 0) as cost,
  coalesce(e.best.audit, '') as audit, sha256(coalesce(left(e.best.lines, length(e.best.lines) - 1), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counted c on c.conv_id is not distinct from o.conv_id
  left join ended e on e.conv_id is not distinct from o.conv_id
"""


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as w
  from (select lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece from documents)
), total as (
  select lang, sum(len(w))::bigint as n from pieces group by lang
), grams as (
  select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, k
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from pieces, range(1, 6) as lengths(k) where len(w) >= k)
), counts as (
  select lang, phrase, any_value(k) as k, count(*) as f from grams group by lang, phrase having count(*) >= 100
), candidates as (
  select lang, phrase, string_split(phrase, ' ') as w, f as a from counts where k >= 2
), cuts as (
  select lang, phrase, w, a, unnest(range(1, len(w))) as k from candidates
), scored as (
  select c.lang, c.phrase, c.a, t.n, x.f as l, y.f as r, (1000::hugeint * c.a * t.n) // (x.f::hugeint * y.f) as score, c.k
  from cuts c join total t on t.lang = c.lang
    join counts x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
    join counts y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_parts as (
  select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, max(a) as longest
  from (select lang, w, a, m, unnest(range(1, len(w) - m + 2)) as i from candidates, range(2, 5) as sizes(m) where len(w) > m)
  group by 1, 2
), kept as (
  select o.* from lowest o left join inner_parts p on p.lang = o.lang and p.phrase = o.phrase
  where p.longest is null or 100 * p.longest < 100 * o.a
)
select lang, rank, phrase, a, l, r, n, score::bigint as score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
where rank <= 2000
"""


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_convert.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


OP13_SQL = """
with p as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest,
    row_number() over (partition by coalesce(html, '') order by page_id desc nulls last) as rn,
    max(page_id) over (partition by coalesce(html, '')) as largest
  from pages
)
select page_id, strlen(payload)::bigint as payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(digest, (i // 4 * 5 + 1)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31) + 1, 1)), 'string_agg', '') as payload_digest,
  case when rn = 1 then 'response' else 'revisit' end as record_type,
  case when rn > 1 then largest end as refers_to
from p
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing_sources": op1_mixing_sources,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_language_id": op3_language_id,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_line_dedup": op8_line_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_token_output": op10_token_output,
    "op11_conversation_structure_repair": op11_conversation_structure_repair,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_warc": op13_warc,
}

ORACLE_SQL: dict[str, str] = {
    "op1_mixing_sources": OP1_SQL,
    "op4_exact_top_k": OP4_SQL,
    "op11_conversation_structure_repair": OP11_SQL,
    "op12_phrase_collocations": OP12_SQL,
    "op13_warc": OP13_SQL,
}
