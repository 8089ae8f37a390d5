"""SQL for the rows of those numbered queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
with d as (select doc_id, {_WORDS} as w from documents),
i as (select item_id::varchar as item, {_WORDS} as w from benchmark),
p as (select item, w, least(10, len(w)) as n, unnest(range(1, (len(w) - least(10, len(w)) + 2)::bigint)) as pos from i where len(w) > 0),
windows as (select distinct item, array_to_string(w[pos:pos + n - 1], ' ') as win, n from p),
probes as (select doc_id, w, n, unnest(range(1, (len(w) - n + 2)::bigint)) as pos from d cross join (select distinct n from windows) where len(w) >= n),
hits as (select doc_id, pos, probes.n, item from probes join windows on array_to_string(w[pos:pos + probes.n - 1], ' ') = win and probes.n = windows.n),
covered as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(pos, pos + n)) as pos from hits) group by doc_id),
items as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from hits group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join covered using (doc_id) left join items using (doc_id)"""


def _base32(digits: str) -> str:
    """Base32 of 40 hexadecimal digits: each letter takes five of the eight bits of two digits."""
    letters = []
    for k in range(32):
        at, shift = 5 * k // 4, 3 - 5 * k % 4
        value = [f"(strpos('0123456789abcdef', substr({digits}, {at + j}, 1)) - 1)" for j in (1, 2)]
        letters.append(f"substr('{_UPPER}234567', ((({value[0]} * 16 + {value[1]}) >> {shift}) & 31)::bigint + 1, 1)")
    return " || ".join(letters)


OP9 = f"""
with h as (select page_id, coalesce(html, '') as payload, lower(sha1(coalesce(html, ''))) as x, max(page_id) over (partition by coalesce(html, '')) as first from pages)
select page_id, octet_length(encode(payload))::bigint as payload_bytes, {_base32('x')} as payload_digest,
case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to from h"""

OP10 = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
w as (select doc_id, pos, substr(x, 2 * pos + 1, 100) as s from (select doc_id, x, unnest(range(0, (length(x) // 2 - 49)::bigint)) as pos from d where length(x) >= 100)),
f as (select s, min(doc_id) as least from w group by s having count(distinct doc_id) > 1),
m as (select w.doc_id, pos, lag(pos) over (partition by w.doc_id order by pos) as prev from w join f using (s) where w.doc_id > least),
n as (select doc_id, pos, sum((prev is null or pos > prev + 50)::int) over (partition by doc_id order by pos rows unbounded preceding) as span from m),
spans as (select doc_id, min(pos) as b, max(pos) + 50 as e from n group by doc_id, span),
cuts as (select doc_id, coalesce(lag(e) over (partition by doc_id order by b), 0) as b, b as e from spans
union all select d.doc_id, coalesce(max(e), 0), any_value(length(x)) // 2 from d left join spans using (doc_id) group by d.doc_id),
kept as (select doc_id, string_agg(substr(x, (2 * b + 1)::bigint, (2 * (e - b))::bigint), '' order by b) as k from cuts join d using (doc_id) group by doc_id)
select doc_id, (length(x) // 2)::bigint as n_bytes, coalesce(r, 0)::bigint as n_removed, coalesce(c, 0)::bigint as n_spans, sha256(unhex(k)) as kept_sha256
from d join kept using (doc_id) left join (select doc_id, sum(e - b) as r, count(*) as c from spans group by doc_id) using (doc_id)"""

OP12 = """
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
('0x' || substr(md5('mix|' || coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')), 1, 13))::bigint / 4503599627370496.0::double as draw from documents),
s as (select source, sum(size)::bigint as own, [5, 2, 1][(row_number() over (order by encode(source) nulls last) - 1) % 3 + 1]::bigint as weight from d group by source),
f as (select *, coalesce(sum(2 * own) over v, 0) as caps, sum(weight) over () - coalesce(sum(weight) over v, 0) as open, sum(own) over () as words from s
window v as (order by 2 * own / weight, encode(source) nulls last rows between unbounded preceding and 1 preceding)),
l as (select max_by({'rest': (words * 1.5 - caps)::double, 'open': open::double}, (words * 1.5 - caps)::double / open::double) as level from f),
t as (select source, own, least((2 * own)::double, level['rest'] * weight / level['open']) as target from s, l),
r as (select doc_id, size, own as source_size, target, draw, case when own > 0 then target / own else 0.0 end as rate from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target, (size * (floor(rate) + (draw < rate - floor(rate))::int))::bigint as taken from r"""


def _codes(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Product codes, a round a pair of tables: nearest entries, then their parts' means."""
    near = "select a.vec_id, a.part, any_value(a.v) as v, min({far} * 256 + entry) as best from p a join c{r} b using (part) group by a.vec_id, a.part"
    far = "list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::hugeint"
    steps = [
        """k as materialized (select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v from embeddings
where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"w as materialized (select max(len(v)) // {parts} as width from k)",
        f"p as materialized (select vec_id, label, part, v[part * width + 1:(part + 1) * width] as v from k, w, range({parts}) r(part))",
        f"c0 as materialized (select part, rank as entry, v from p join (select vec_id, row_number() over (order by vec_id) - 1 as rank from k qualify rank < {entries}) using (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} as materialized ({near.format(far=far, r=r)})")
        if r < rounds:
            steps.append(
                f"m{r} as materialized (select part, entry, list(mean order by place) as v from (select part, (best % 256)::bigint as entry, place, floor(sum(x)::double / count(*))::bigint as mean "
                f"from (select part, best, unnest(v) as x, generate_subscripts(v, 1) as place from a{r}) group by all) group by part, entry)"
            )
            steps.append(f"c{r + 1} as materialized (select part, entry, coalesce(m{r}.v, c{r}.v) as v from c{r} left join m{r} using (part, entry))")
    steps.append(f"e as (select vec_id, string_agg(lower(lpad(to_hex((best % 256)::bigint), 2, '0')), '' order by part) as code, sum(best // 256)::bigint as error from a{rounds} group by vec_id)")
    steps.append(f"b as (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as codebooks_sha256 from c{rounds})")
    return f"with {', '.join(steps)} select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from e join k using (vec_id), b"


OP13 = _codes()

ORACLE_SQL = {"op6_decontamination": OP6, "op9_warc": OP9, "op10_rindex": OP10, "op12_mixing": OP12, "op13_codes": OP13}
