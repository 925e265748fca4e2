"""Queries of this subpackage that SQL can express, for the checking engine."""

from __future__ import annotations

ORACLE = {}

ORACLE["op1_embedding_near_dedup"] = """
with recursive sound as materialized (
    select vec_id, label, cast(embedding as double[]) as e from embeddings
    where label is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as materialized (
    select a.vec_id as x, b.vec_id as y
    from sound a join sound b
      on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (
    select vec_id as node, vec_id as root from embeddings
    union
    select links.y, reach.root from reach join links on links.x = reach.node),
classes as materialized (select node, min(root) as component_id from reach group by node),
counts as materialized (select x, count(*) as n from links group by x)
select v.vec_id, cast(coalesce(counts.n, 0) as bigint) as n_links, classes.component_id,
       v.vec_id = classes.component_id as kept
from embeddings v join classes on classes.node = v.vec_id left join counts on counts.x = v.vec_id
"""

ORACLE["op3_ngram_jaccard_join"] = r"""
with recursive words as materialized (
    select doc_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') as w
    from documents),
starts as materialized (
    select doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) as i from words),
shingles as materialized (select distinct doc_id, array_to_string(w[i : i + 3], ' ') as s from starts),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
several as materialized (
    select s, row_number() over () as k from shingles group by s having count(*) > 1),
held as materialized (
    select shingles.doc_id, sizes.n, several.k
    from shingles join several on several.s = shingles.s join sizes on sizes.doc_id = shingles.doc_id),
shared as materialized (
    select a.doc_id as x, b.doc_id as y, count(*) as n
    from held a join held b on a.k = b.k
    where a.doc_id <> b.doc_id and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n
    group by a.doc_id, b.doc_id),
links as materialized (
    select shared.x, shared.y
    from shared join sizes p on p.doc_id = shared.x join sizes q on q.doc_id = shared.y
    where 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
reach as (
    select x as node, y as root from links
    union
    select links.y, reach.root from reach join links on links.x = reach.node),
classes as materialized (select node, min(root) as component_id from reach group by node)
select d.doc_id, cast(coalesce(sizes.n, 0) as bigint) as n_shingles,
       least(d.doc_id, coalesce(classes.component_id, d.doc_id)) as component_id
from documents d left join classes on classes.node = d.doc_id left join sizes on sizes.doc_id = d.doc_id
"""

ORACLE["op13_exact_top_k"] = """
with sound as materialized (
    select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
    from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
    from sound q join sound c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored)
select query_id, cast(place as integer) as rank, vec_id, score from ranked where place <= 5
"""
