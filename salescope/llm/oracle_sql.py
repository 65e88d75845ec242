"""SQL for the operators that SQL can express."""

CHAT = r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized as (
    select *, length(regexp_replace(replace(role, '\', '\\'), '(<|\[)(/?s>|/?INST\])', '\1\\\2', 'g'))
        + length(regexp_replace(replace(text, '\', '\\'), '(<|\[)(/?s>|/?INST\])', '\1\\\2', 'g')) + 20 as chars,
        row_number() over (partition by conv_id order by turn nulls first, role, text) as place,
        count(*) over (partition by conv_id) as turns
    from rows
), summed as (
    select *, sum(chars) over (partition by conv_id order by place) as before from sized
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
    coalesce(length(string_agg(case when role = 'assistant' then text end, '' order by place)), 0) as loss_chars,
    sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by place), '')) as loss_sha256,
    cast(sum(case when role = 'assistant' or place = turns then before else 0 end) as bigint) as formatted_chars
from summed group by conv_id
"""

NEAREST = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, d.vec_id as vec_id,
        cast(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) as bigint) as score
    from whole q join whole d on d.vec_id <> q.vec_id and len(d.v) = len(q.v)
    where q.vec_id % 50 = 0
), ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

MIXTURE = r"""
with rows as (
    select doc_id, coalesce(source, '') as source, source is null as nameless,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
        substr(md5(coalesce(cast(doc_id as varchar), '') || case when text is null then '' else chr(10) || text end), 1, 15) as key
    from documents
), sources as (
    select source, nameless, cast(sum(size) as bigint) as source_size,
        case (row_number() over (order by nameless, source) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
    from rows group by source, nameless
), filled as (
    select *, coalesce(sum(3 * source_size) over earlier, 0) as full_before, coalesce(sum(weight) over earlier, 0) as spent,
        sum(source_size) over () as words, sum(weight) over () as weights
    from sources
    window earlier as (order by cast(source_size as double) / weight, nameless, source rows between unbounded preceding and 1 preceding)
), targets as (
    select source, nameless, source_size,
        least(cast(3 * source_size as double),
            max(cast(words - full_before as double) / cast(weights - spent as double)) over () * weight) as target
    from filled
), budgets as (
    select *, least(3 * source_size, cast(floor(target + 0.5) as bigint)) as budget from targets
), placed as (
    select *, cast(coalesce(sum(size) over (partition by source, nameless order by key, doc_id, size
        rows between unbounded preceding and 1 preceding), 0) as bigint) as before
    from rows
)
select doc_id, size, source_size, target,
    case when source_size = 0 then 0
        else (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) end as taken
from placed join budgets using (source, nameless)
"""

ORACLE = {"op12_source_mixture": MIXTURE, "op2_chat_formatting": CHAT, "op10_nearest_vectors": NEAREST}
