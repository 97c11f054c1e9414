"""SQL for the queries that SQL can express."""

from __future__ import annotations

NOT_WHITE = r"[^\x20\x09-\x0D]+"


def mixing_sql(flatten: float = 0.85, sweeps: int = 12, seed: int = 17) -> str:
    """Raking as one step after the other; a step scales the cells of each value to its target."""
    def times(pattern: str) -> str:
        return f"len(regexp_extract_all(text, '{pattern}'))"

    steps = [rf"""
        marked as (
            select doc_id, coalesce(source, '<null>') as source, coalesce(lang, '<null>') as lang,
                case when text is null or length(text) = 0 then 'empty'
                     when 100 * {times('[|]')} >= 2 * length(text) then 'table'
                     when 100 * {times('[#*$%&<>{}=]|[[]|[]]')} >= 3 * length(text) then 'markup'
                     when 100 * {times('[0-9]')} >= 3 * length(text) then 'record'
                     when 200 * (length(text) - length(replace(text, chr(10), ''))) >= length(text) then 'list'
                     else 'prose' end as topic,
                coalesce({times(NOT_WHITE)}, 0) as n_tokens
            from documents),
        cells0 as (select source, lang, topic, sum(n_tokens)::bigint as tokens, sum(n_tokens)::double as weight from marked group by all)"""]
    for d in ("source", "lang", "topic"):
        steps.append(f"""
        raw_{d} as (select {d}, pow(sum(tokens), {flatten}) as share from cells0 group by {d} having sum(tokens) > 0),
        target_{d} as (select {d}, share / sum(share) over () as share from raw_{d})""")
    at = 0
    for _ in range(sweeps):
        for d in ("source", "lang", "topic"):
            steps.append(f"""
        cells{at + 1} as materialized (
            select c.source, c.lang, c.topic, c.tokens,
                case when sum(weight) over (partition by c.{d}) > 0 then weight * coalesce(t.share, 0) / sum(weight) over (partition by c.{d}) else 0 end as weight
            from cells{at} c left join target_{d} t on c.{d} = t.{d})""")
            at += 1
    return "with" + ",".join(steps) + f""",
        ratios as (select source, lang, topic, case when tokens > 0 then weight / tokens else 0 end as ratio from cells{at}),
        chances as (select source, lang, topic, ratio / max(ratio) over () as chance from ratios)
        select doc_id, topic, n_tokens::bigint as n_tokens, round(chance, 9) as chance,
            ('0x' || substr(md5('{seed}:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint / 4294967296.0 < chance as kept
        from marked join chances using (source, lang, topic)"""


NGRAM_JOIN = rf"""
with recursive
    split as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{NOT_WHITE}') as w from documents),
    shingles as (
        select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s
        from split),
    sizes as (select doc_id, count(s) as n from split left join shingles using (doc_id) group by doc_id),
    common as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
    links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
    both_ways as (select a, b from links union all select b, a from links),
    reach as (select doc_id as a, doc_id as b from documents union select r.a, e.b from reach r join both_ways e on r.b = e.a)
select doc_id, n as n_shingles, (select min(b) from reach where a = doc_id) as component_id from sizes
"""


FILL_MIDDLE = r"""
with
    drawn as (
        select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u, sha256('7:' || doc_id) as h
        from documents),
    numbered as (
        select doc_id, text, u, len(u)::bigint as n, ('0x' || h[1:8])::bigint % (len(u) + 1) as c1, ('0x' || h[9:16])::bigint % (len(u) + 1) as c2,
            ('0x' || h[17:24])::bigint % 100 as pick, ('0x' || h[25:32])::bigint % 100 as kind
        from drawn),
    cut as (
        select doc_id, text, n,
            case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or pick >= 100 then 'plain' when kind < 50 then 'spm' else 'psm' end as form,
            array_to_string(u[1:least(c1, c2)], '') as prefix, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') as middle,
            array_to_string(u[greatest(c1, c2) + 1:], '') as suffix
        from numbered)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end::bigint as prefix_chars, case when form <> 'plain' then length(middle) end::bigint as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from cut
"""


def vector_codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Plain k-means on each part: every distance of every round."""
    steps = [f"""
        kept as (
            select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as x, len(embedding) // {parts} as w
            from embeddings where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
        parts as materialized (select vec_id, label, p, x[p * w + 1:p * w + w] as v from kept, range({parts}) t(p)),
        book0 as materialized (select p, (row_number() over (partition by p order by vec_id) - 1) as e, v from parts qualify e < {entries})"""]
    distance = "list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])))::hugeint"
    for r in range(rounds + 1):
        steps.append(f"""
        near{r} as materialized (select a.vec_id, a.label, a.p, any_value(a.v) as v, min({distance} * 256 + b.e) as best from parts a join book{r} b on a.p = b.p group by all)""")
        if r < rounds:
            steps.append(f"""
        sums{r} as (select p, best % 256 as e, k, sum(v[k])::hugeint as s, count(*) as n from near{r}, range(1, len(v) + 1) t(k) group by all),
        means{r} as (select p, e, list((s - ((s % n) + n) % n) // n order by k)::bigint[] as v from sums{r} group by p, e),
        book{r + 1} as materialized (select b.p, b.e, coalesce(m.v, b.v) as v from book{r} b left join means{r} m on b.p = m.p and b.e = m.e)""")
    return "with" + ",".join(steps) + f""",
        coded as (select vec_id, label, string_agg(printf('%02x', (best % 256)::int), '' order by p) as code, sum(best // 256)::bigint as error from near{rounds} group by vec_id, label)
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
            (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) from book{rounds}) as codebooks_sha256
        from coded"""


def llm_oracles() -> dict[str, str]:
    return {"op1_mixing": mixing_sql(), "op5_ngram_join": NGRAM_JOIN, "op11_vector_codes": vector_codes_sql(), "op12_fill_middle": FILL_MIDDLE}
