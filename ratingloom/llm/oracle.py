"""DuckDB SQL with the same result as those operator queries that SQL can state."""

from ratingloom.llm.quality import BASE_FAILED, BITS, PRIOR, RULES, SPREAD

_BREAK = r"[\x20\x09-\x0D]+"
_WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{_BREAK}'), lambda x: x <> '')"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_NEAR_DUPLICATES = rf"""
    with recursive lowered as (select doc_id, translate(text, '{_UPPER}', '{_LOWER}') as text from documents),
    texts as (select doc_id, {_WORDS} as words from lowered),
    shingles as (
        select distinct doc_id, array_to_string(words[i:i + 3], ' ') as shingle
        from (select doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) as i from texts where len(words) > 0)),
    sizes as (select doc_id, count(*) as n from shingles group by doc_id),
    pairs as (
        select a.doc_id as a, b.doc_id as b, count(*) as shared
        from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
    links as (
        select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
        where 100 * shared >= 80 * (x.n + y.n - shared)),
    either as (select a, b from links union all select b, a from links),
    reach as (select doc_id as a, doc_id as b from documents
              union select r.a, e.b from reach r join either e on r.b = e.a),
    components as (select a, min(b) as component_id from reach group by a)
    select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
    from documents d left join sizes s on d.doc_id = s.doc_id join components c on d.doc_id = c.a"""

_TOP_K = """
    with vectors as (
        select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as w from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scores as (
        select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.w, c.w) as bigint) as score
        from vectors q join vectors c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
    select * from (
        select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
        from scores)
    where rank <= 5"""


_HARD_NEGATIVES = """
    with vectors as (
      select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
             list_transform(embedding, lambda x: floor(256 * cast(x as double))) as w from embeddings
      where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scores as (
      select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id, cast(list_dot_product(a.w, b.w) as bigint) as score
      from vectors a join vectors b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
    positives as (
      select anchor_id, vec_id as positive_id, score as positive_score from scores where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select anchor_id, positive_id,
           cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as int) as rank,
           vec_id as negative_id, positive_score, score as negative_score
    from positives join scores using (anchor_id)
    where not same and 80 * positive_score <= 100 * score and score <= positive_score
    qualify rank <= 5"""


def _rules() -> str:
    return " union all ".join(
        f"select n, lang, source, '{r.name}' as rule, {BASE_FAILED} as failed, "
        f"case when {r.whole} > 0 then (1000000 * (2 * {r.part} + 1)) // (2 * {r.whole} + 1) end as v from measured"
        for r in RULES
    )


def _fence(keys: str) -> str:
    """Outer fence of every group; ``keys`` end with a comma."""
    over = f"partition by {keys} rule"
    return f"""
        select {keys} rule, total, q3 {"* (q3 / q1) " * SPREAD} as fence
        from (select {keys} rule, cast(max(total) as double) as total,
                     cast(min(bucket) filter (below * 4 >= total) as double) as q1,
                     cast(min(bucket) filter (below * 4 >= total * 3) as double) as q3
              from (select {keys} rule, bucket, sum(n) over ({over} order by bucket) as below, sum(n) over ({over}) as total
                    from (select {keys} rule, bucket, count(*) as n from buckets where not failed group by all))
              group by {keys} rule)"""


def _blended(group: str, wider: str) -> str:
    weight = f"({group}.total / ({group}.total + cast({PRIOR} as double)))"
    return f"({weight} * ln({group}.fence) + (cast(1 as double) - {weight}) * {wider})"


_QUALITY = rf"""
    with numbered as (select row_number() over () as n, * from documents),
    words as (select n, doc_id, lang, source, coalesce(text, '') as text, {_WORDS} as words,
                     list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
              from numbered),
    thirds as (select n, unnest(range(1, len(words) - 1)) as i,
                      unnest(list_transform(range(1, len(words) - 1),
                             lambda k: words[k] || ' ' || words[k + 1] || ' ' || words[k + 2])) as third from words),
    windows as (select n, i, count(*) over (partition by n, third) as times from thirds),
    repeated as (select n, count(distinct place) as n_repeat_words
                 from (select n, unnest([i, i + 1, i + 2]) as place from windows where times > 1) group by n),
    measured as (
        select w.n, doc_id, lang, source, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(lines) as n_lines,
               len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
        from words w left join repeated r on w.n = r.n),
    valued as ({_rules()}),
    buckets as (select *, ((v >> greatest(length(bin(v)) - {BITS}, 0)) + 1) << greatest(length(bin(v)) - {BITS}, 0) as bucket
                from valued where v is not null),
    by_group as ({_fence('lang, source,')}),
    by_lang as ({_fence('lang,')}),
    by_all as ({_fence('')}),
    above as (
        select v.n, bool_or(v.v > exp({_blended("g", _blended("l", "ln(a.fence)"))})) as above
        from buckets v
        join by_group g on v.rule = g.rule and v.lang is not distinct from g.lang and v.source is not distinct from g.source
        join by_lang l on v.rule = l.rule and v.lang is not distinct from l.lang
        join by_all a on v.rule = a.rule group by v.n),
    judged as (select m.*, {BASE_FAILED} as base_failed, coalesce(above, false) as above
               from measured m left join above a on m.n = a.n)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not above as kept
    from judged"""

SQL = {
    "op5_circulant_minhash": _NEAR_DUPLICATES,
    "op9_exact_topk": _TOP_K,
    "op10_quality_rules": _QUALITY,
    "op11_hard_negatives": _HARD_NEGATIVES,
}
