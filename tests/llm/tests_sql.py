"""Reference SQL for tests."""

PII_BASE = {
    "email": ("[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+", "true"),
    "ip": (
        "[0-9]+(?:\\.[0-9]+)(?:\\.[0-9]+)(?:\\.[0-9]+)",
        "len([p for p in string_split(m, '.') if cast(p as hugeint) > 255]) = 0",
    ),
    "card": (
        "[0-9](?:[ -]?[0-9])+",
        "length(d) between 13 and 19 and list_sum([case when i % 2 = 1 then cast(substring(r, i, 1) as int) "
        "else (2 * cast(substring(r, i, 1) as int)) // 10 + (2 * cast(substring(r, i, 1) as int)) % 10 end "
        "for i in range(1, length(r) + 1)]) % 10 = 0",
    ),
    "phone": ("\\+[0-9][ ().0-9-]+[0-9]", "length(d) between 9 and 15"),
}


def pii_sql() -> str:
    """Counts and digest of the base spans of documents."""
    parts = []
    for order, (kind, (pattern, good)) in enumerate(PII_BASE.items()):
        parts.append(f"""
    select rid, {order} as o, '{kind}' as kind, s, s + length(m) as e from (
        select rid, m, regexp_replace(m, '[^0-9]', '', 'g') as d, reverse(regexp_replace(m, '[^0-9]', '', 'g')) as r,
            cast(list_sum([length(x) for x in ps[1:i]]) + coalesce(list_sum([length(x) for x in ms[1:i - 1]]), 0) as bigint) as s
        from (select rid, ms, ps, i, ms[i] as m from (
            select rid, ms, ps, unnest(range(1, len(ms) + 1)) as i from (
                select rid, regexp_extract_all(text, '{pattern}') as ms, string_split_regex(text, '{pattern}') as ps
                from docs)))) where {good}""")
    spans = " union all ".join(parts)
    return f"""
with docs as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
found as ({spans}),
lists as (
    select rid, count(*) filter (kind = 'email') as n_email, count(*) filter (kind = 'ip') as n_ip,
        count(*) filter (kind = 'card') as n_card, count(*) filter (kind = 'phone') as n_phone,
        string_agg(kind || ':' || s || ':' || e, ',' order by o, s) as listed
    from found group by rid)
select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card,
    coalesce(n_phone, 0) as n_phone, sha256(coalesce(listed, '')) as base_sha256
from docs left join lists using (rid)
"""
