"""The operators' queries and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from .ann import op2_ann
from .bpe import op3_bpe
from .centroids import op12_centroids, op12_sql
from .fim import op11_fill_in_middle, op11_sql
from .html_extract import op10_html
from .jaccard import op6_jaccard
from .near_dedup import op1_near_dedup
from .packing import op8_best_fit
from .pieces import op13_sentencepiece
from .quality_fm import op5_quality
from .token_store import op7_token_store
from .toxicity import op9_toxicity
from .url_filter import op4_sql, op4_url_filter

QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_ann, op3_bpe, op4_url_filter, op5_quality, op6_jaccard, op7_token_store, op8_best_fit, op9_toxicity, op10_html, op11_fill_in_middle, op12_centroids, op13_sentencepiece)}

#: Nearest neighbours by inner product, every query row against all rows.  Sums run in component
#: order in both engines, so that scores are equal to the last bit.
_OP2 = """
with good as (
    select vec_id, list_transform(embedding, lambda x: cast(x as double)) v from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored as (
    select q.vec_id query_id, r.vec_id, list_reduce(list_prepend(0.0::double, list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * r.v[i])), lambda a, b: a + b) score
    from good q join good r on q.vec_id <> r.vec_id and len(q.v) = len(r.v) where q.vec_id % 20 = 0)
select query_id, cast(rank as integer) rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from scored)
where rank <= 20"""

ORACLES = {"op2_ann": _OP2, "op4_url_filter": op4_sql(), "op11_fill_in_middle": op11_sql(), "op12_centroids": op12_sql()}
