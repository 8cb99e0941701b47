"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import (
    collision_dedup, dart_dedup, fill_middle, forest_search, language_id, merkle, mixture, norm_search, packing, repeats, secrets, token_counts, token_files,
)
from lakeops.llm.work import read


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_search.nearest(read(spark, sf_dir, "embeddings"))


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_files(token_files.write_files(read(spark, sf_dir, "documents")))


def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_prefixes(read(spark, sf_dir, "documents"))
    return token_counts.with_limit(counted).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_search.top_products(read(spark, sf_dir, "embeddings"))


def middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(read(spark, sf_dir, "documents"))
    text = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")
    )


def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ecoc_language_id": languages,
    "op2_pivotal_mixture": source_mix,
    "op3_structural_secrets": secret_scan,
    "op4_projection_forest": neighbours,
    "op5_context_mixing_ids": token_ids,
    "op6_variable_best_fit": best_fit,
    "op7_prefix_token_counts": token_totals,
    "op8_prefix_suffix_trees": repeat_removal,
    "op9_dart_minhash_dedup": near_dedup,
    "op10_collision_dedup": vector_dedup,
    "op11_norm_sorted_search": top_products,
    "op12_postorder_merkle": dataset_manifest,
    "op13_chunked_fill_middle": middles,
}

_WORDS = r"words as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as ws from documents)"
# The smallest node reachable from each node, itself included; `nodes` has id, `pairs` has links in both directions as (x, y).
_REACH = """reach(a, b) as (select id, id from nodes union select reach.a, pairs.y from reach join pairs on reach.b = pairs.x),
  low as (select a, min(b) as component from reach group by 1)"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || ({value}), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id::varchar", "source", "lang", f"({n_chars})::varchar", "text"])) + ")"


# CRC-32 of a number's decimal digits, bit by bit.
_CRC = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))))"""

ORACLE = {
    "op8_prefix_suffix_trees": f"""with {_WORDS},
      passages as (select doc_id, unnest(range(1, len(ws) - 33)) as p,
        unnest(list_transform(range(1, len(ws) - 33), lambda p: array_to_string(ws[p:p + 34], ' '))) as k from words where len(ws) >= 35),
      twice as (select k from passages group by 1 having count(*) > 1),
      hit as (select distinct doc_id, unnest(range(p, p + 35)) as i from passages where k in (select k from twice)),
      places as (select doc_id, unnest(range(1, len(ws) + 1)) as i, unnest(ws) as word from words),
      kept as (select places.doc_id, string_agg(word, ' ' order by places.i) as t from places anti join hit on places.doc_id = hit.doc_id and places.i = hit.i group by 1),
      gone as (select doc_id, count(*) as n from hit group by 1)
      select words.doc_id, len(ws) as n_words, coalesce(gone.n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
      from words left join gone on words.doc_id = gone.doc_id left join kept on words.doc_id = kept.doc_id""",
    "op9_dart_minhash_dedup": f"""with recursive {_WORDS},
      sets as (select distinct doc_id, unnest(case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda p: array_to_string(ws[p:p + 4], ' '))
        when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s from words),
      sizes as (select doc_id, count(*) as n from sets group by 1),
      common as (select a.doc_id as x, b.doc_id as y, count(*) as c from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
      links as (select x, y from common join sizes p on x = p.doc_id join sizes q on y = q.doc_id where c::double / (p.n + q.n - c) >= 0.8),
      pairs as (select x, y from links union all select y, x from links),
      nodes as (select doc_id as id from documents), {_REACH}
      select a as doc_id, coalesce(n, 0) as n_shingles, component as class_id, a = component as kept from low left join sizes on a = doc_id""",
    "op10_collision_dedup": f"""with recursive vectors as (select vec_id as id, embedding::double[] as v from embeddings),
      links as (select a.id as x, b.id as y from vectors a join vectors b on a.id < b.id and list_cosine_similarity(a.v, b.v) >= 0.95),
      pairs as (select x, y from links union all select y, x from links),
      nodes as (select id from vectors), {_REACH}
      select a as vec_id, (select count(*) from pairs where x = a) as n_links, component as component_id, a = component as kept from low""",
    "op12_postorder_merkle": f"""with recursive rows as (select row_number() over () as r, doc_id, coalesce('=' || lang, '') as tree,
        {_leaf("n_chars")} as leaf, case when {_CRC} % 7 = 0 then {_leaf("n_chars + 1")} else {_leaf("n_chars")} end as shown from documents),
      placed as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by tree) as m from rows),
      nodes(tree, h, m, i, d) as (select tree, 0, m, i, leaf from placed
        union all select tree, h + 1, (m + 1) // 2, i // 2, sha256(string_agg(d, '' order by i)) from nodes where m > 1 group by tree, h, m, i // 2),
      subroots as (select tree, d, row_number() over (order by tree) - 1 as i, count(*) over () as m from nodes where m = 1),
      over_(h, m, i, d) as (select 0, m, i, d from subroots
        union all select h + 1, (m + 1) // 2, i // 2, sha256(string_agg(d, '' order by i)) from over_ where m > 1 group by h, m, i // 2),
      steps as (select p.r, a.h, case when b.i < a.i then 'L' else 'R' end || coalesce(b.d, '') as step from placed p
          join nodes a on a.tree = p.tree and a.m > 1 and a.i = p.i >> a.h left join nodes b on b.tree = a.tree and b.h = a.h and b.i = xor(a.i, 1)
        union all select p.r, 1000 + a.h, case when b.i < a.i then 'L' else 'R' end || coalesce(b.d, '') from placed p join subroots s on s.tree = p.tree
          join over_ a on a.m > 1 and a.i = s.i >> a.h left join over_ b on b.h = a.h and b.i = xor(a.i, 1)),
      proofs as (select r, list(step order by h) as path from steps group by r),
      folded as (select p.doc_id, p.leaf, s.d as subroot, (select d from over_ where m = 1) as root, list_transform(coalesce(path, []), lambda x: x[2:]) as siblings,
          list_reduce([p.shown] || coalesce(path, []), lambda a, x: sha256(case when x[1] = 'L' then x[2:] || a else a || x[2:] end)) as folded_root
        from placed p join subroots s on s.tree = p.tree left join proofs q on q.r = p.r)
      select doc_id, leaf, subroot, root, sha256(array_to_string(siblings, '')) as proof_sha256, folded_root, folded_root = root as verified from folded""",
    "op11_norm_sorted_search": """with whole as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
        where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
      pairs as (select q.vec_id as query_id, c.vec_id, max(list_dot_product(q.v, c.v))::bigint as score from whole q join whole c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id group by 1, 2)
      select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from pairs qualify rank <= 20""",
    "op13_chunked_fill_middle": """with keys as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as k from documents),
      draws as (select *, length(t) as n, ('0x' || k[1:8])::bigint as h1, ('0x' || k[9:16])::bigint as h2, ('0x' || k[17:24])::bigint as h3, ('0x' || k[25:32])::bigint as h4 from keys),
      forms as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from draws),
      pieces as (select *, substring(t, 1, a) as p, substring(t, a + 1, b - a) as m, substring(t, b + 1) as s from forms)
      select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
        sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
        sha256(t) as restored_sha256 from pieces""",
}
