"""SQL of operators from their definitions: plain joins and recursion instead of tiles, codes, automata and linked audits."""

#: Near copies: sets of shingles, classes of equal sets, links by counting common shingles.
NGRAM_JACCARD = r"""
with recursive words as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
    from documents
), sets as materialized (
    select doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
        lambda i: array_to_string(w[i:i + 4], ' ')))) as s, len(w) as n_words
    from words
), sized as materialized (
    select doc_id, cast(case when n_words = 0 then 0 else len(s) end as bigint) as n_shingles,
        case when n_words = 0 then null else s end as s
    from sets
), classes as materialized (
    select s, min(doc_id) as class_id, any_value(n_shingles) as n from sized where s is not null group by s
), shingles as materialized (
    select class_id, n, unnest(s) as shingle from classes
), links as materialized (
    select a.class_id as a, b.class_id as b
    from shingles a join shingles b on a.shingle = b.shingle and a.class_id < b.class_id
        and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    group by a.class_id, b.class_id, a.n, b.n
    having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edges as materialized (
    select a, b from links union all select b, a from links
), reach(node, component) as (
    select class_id, class_id from classes
    union
    select e.b, r.component from reach r join edges e on e.a = r.node where r.component < e.b
), components as (
    select node, min(component) as component_id from reach group by node
)
select d.doc_id, d.n_shingles, coalesce(c.class_id, d.doc_id) as class_id, coalesce(k.component_id, d.doc_id) as component_id
from sized d left join classes c on d.s = c.s left join components k on k.node = c.class_id
"""

#: Near-duplicate vectors: every pair of a label in double precision.
EMBEDDING_DEDUP = r"""
with recursive usable as materialized (
    select vec_id, label, len(embedding) as dim, cast(embedding as double[]) as v
    from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as materialized (
    select a.vec_id as a, b.vec_id as b
    from usable a join usable b on a.label = b.label and a.dim = b.dim and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.v, b.v) >= 0.93
), reach(node, component) as (
    select vec_id, vec_id from usable
    union
    select l.b, r.component from reach r join links l on l.a = r.node where r.component < l.b
), components as (
    select node, min(component) as component_id from reach group by node
), counts as (
    select a, count(*) as n_links from links group by a
)
select e.vec_id, coalesce(n.n_links, 0) as n_links, coalesce(c.component_id, e.vec_id) as component_id,
    e.vec_id = coalesce(c.component_id, e.vec_id) as kept
from embeddings e left join counts n on n.a = e.vec_id left join components c on c.node = e.vec_id
"""

#: Repeated passages: every window by its words, numbered by where it starts.
SUBSTRING_DEDUP = r"""
with words as materialized (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
    from documents
), windows as (
    select doc_id, i, array_to_string(w[i:i + 19], ' ') as piece
    from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from words)
), repeated as (
    select doc_id, i from windows qualify row_number() over (partition by piece order by doc_id, i) > 1
), gone as materialized (
    select distinct doc_id, unnest(range(i, i + 20)) as i from repeated
), placed as (
    select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from words
), kept as (
    select p.doc_id, string_agg(p.word, ' ' order by p.i) as text, count(*) as n
    from placed p anti join gone g on p.doc_id = g.doc_id and p.i = g.i group by p.doc_id
)
select w.doc_id, cast(len(w.w) as bigint) as n_words, cast(len(w.w) - coalesce(k.n, 0) as bigint) as n_removed,
    sha256(coalesce(k.text, '')) as kept_sha256
from words w left join kept k using (doc_id)
"""

#: Conversation repair from the back: the cheapest and then least rest of an audit from every state, turn by turn.
CONVERSATION_REPAIR = r"""
with recursive keyed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        xor(list_reduce(list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
                lambda letter: cast(ascii(letter) as bigint)),
            lambda crc, byte: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end,
                xor(crc, byte)), cast(4294967295 as bigint)), cast(4294967295 as bigint)) % 20 as fault
    from conversations
), named as materialized (
    select distinct conv_id from conversations
), damaged as (
    select conv_id, turn, case when fault = 4 then 'user' else role end as role,
        case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
        unnest(case when fault = 3 then [0, 1] else [0] end) as copy
    from keyed where fault <> 0
), ordered as (
    select conv_id, turn, role, text, row_number() over (partition by conv_id
        order by turn nulls first, sha256(cast(length(role) as varchar) || ':' || role || text)) as place
    from damaged
), turns as materialized (
    select conv_id, turn, role, text, place, substr(role, 1, 1) as initial,
        substr(role, 1, 1) || lead(substr(role, 1, 1)) over (partition by conv_id order by place) as step,
        case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
            when row_number() over (partition by conv_id, role, text order by place) > 1 then 'duplicate'
            when regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') then 'truncated'
            else '' end as fault
    from ordered
), counted as materialized (
    select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
        count(*) filter (fault = 'truncated') as truncated, count(*) filter (step not in ('su', 'ua', 'au')) as illegal
    from turns group by conv_id
), rests(conv_id, place, s0, s1, s2, s3) as (
    select conv_id, n + 1, {'c': cast(0 as bigint), 'a': ''}, {'c': cast(10 as bigint), 'a': 'II'},
        {'c': cast(5 as bigint), 'a': 'I'}, {'c': cast(0 as bigint), 'a': ''}
    from counted
    union all
    select conv_id, place, list_min([s0, {'c': u.c + 5, 'a': 'I' || u.a}]), list_min([s1, {'c': u.c + 5, 'a': 'I' || u.a}]), u,
        list_min([s3, {'c': s2.c + 5, 'a': 'I' || s2.a}])
    from (
        select *, list_min([s2, {'c': s3.c + 5, 'a': 'I' || s3.a}]) as u
        from (
            select conv_id, place,
                list_min([{'c': s0.c + 2, 'a': 'D' || s0.a}, {'c': s2.c + recast, 'a': 'R' || s2.a},
                    {'c': s2.c + keep + case when initial = 'u' then 0 else 1000000000 end, 'a': 'K' || s2.a},
                    {'c': s1.c + keep + case when initial = 's' then 0 else 1000000000 end, 'a': 'K' || s1.a}]) as s0,
                list_min([{'c': s1.c + 2, 'a': 'D' || s1.a}, {'c': s2.c + recast, 'a': 'R' || s2.a},
                    {'c': s2.c + keep + case when initial = 'u' then 0 else 1000000000 end, 'a': 'K' || s2.a}]) as s1,
                list_min([{'c': s2.c + 2, 'a': 'D' || s2.a}, {'c': s3.c + recast, 'a': 'R' || s3.a},
                    {'c': s3.c + keep + case when initial = 'a' then 0 else 1000000000 end, 'a': 'K' || s3.a}]) as s2,
                list_min([{'c': s3.c + 2, 'a': 'D' || s3.a}, {'c': s2.c + recast, 'a': 'R' || s2.a},
                    {'c': s2.c + keep + case when initial = 'u' then 0 else 1000000000 end, 'a': 'K' || s2.a}]) as s3
            from (
                select r.conv_id, t.place, r.s0, r.s1, r.s2, r.s3, t.initial, k.keep, k.keep + 1 as recast
                from rests r join turns t on r.conv_id is not distinct from t.conv_id and t.place = r.place - 1
                join (values ('', cast(0 as bigint)), ('truncated', 5), ('blank', 1000000000), ('duplicate', 1000000000))
                    as k(fault, keep) on k.fault = t.fault
            )
        )
    )
), audits as materialized (
    select conv_id, s0.c as cost, s0.a as audit from rests where place = 1
), letters as (
    select conv_id, letter, pos, sum(case when letter = 'I' then 0 else 1 end) over (partition by conv_id order by pos) as place
    from (select conv_id, unnest(string_split(audit, '')) as letter, generate_subscripts(string_split(audit, ''), 1) as pos
          from audits where audit <> '')
), emitted as (
    select l.conv_id, l.letter, l.pos, t.role, t.text, row_number() over (partition by l.conv_id order by l.pos)
        - case when bool_or(l.letter = 'K' and t.initial = 's') over (partition by l.conv_id) then 1 else 0 end as spoken
    from letters l left join turns t on l.conv_id is not distinct from t.conv_id and l.place = t.place and l.letter <> 'I'
    where l.letter <> 'D'
), repaired as (
    select conv_id, string_agg(case when letter = 'K' then role when spoken % 2 = 1 then 'user' else 'assistant' end
        || ':' || coalesce(text, ''), chr(10) order by pos) as lines
    from emitted group by conv_id
)
select n.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
    coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, coalesce(a.cost, 0) as cost,
    coalesce(a.audit, '') as audit, sha256(coalesce(r.lines, '')) as repaired_sha256
from named n left join counted c on n.conv_id is not distinct from c.conv_id
    left join audits a on n.conv_id is not distinct from a.conv_id
    left join repaired r on n.conv_id is not distinct from r.conv_id
"""
