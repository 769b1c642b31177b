"""SQL for the queries that SQL can express, written from their definitions and not from the operators."""

from __future__ import annotations

from envgrade.llm.licenses import BASE, LOWER, NOTICES, UPPER

USABLE = "len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0"

NEAR_VECTORS = f"""
with recursive v as (
  select vec_id, [cast(x as double) for x in embedding] as e from embeddings
  where vec_id is not null and {USABLE} and len([x for x in embedding if x <> 0]) > 0),
l as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.95),
reach(vec_id, r) as (
  select vec_id, vec_id from embeddings union select reach.vec_id, l.b from reach join l on reach.r = l.a),
n as (select a, count(*) as n from l group by a)
select vec_id, coalesce(any_value(n.n), 0) as n_links, min(r) as component_id, vec_id = min(r) as kept
from reach left join n on n.a = vec_id group by vec_id
"""

NEAR_TEXTS = r"""
with recursive w as (
  select doc_id, [x for x in string_split_regex(coalesce(text, ''), '\s+') if x <> ''] as words from documents),
s as (
  select doc_id, unnest(list_distinct([array_to_string(words[i : i + 4], ' ')
    for i in range(1, greatest(len(words) - 4, 1) + 1)])) as shingle
  from w where len(words) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
o as (select a.doc_id as a, b.doc_id as b, count(*) as o from s a join s b using (shingle) where a.doc_id <> b.doc_id group by 1, 2),
l as (
  select o.a, o.b, o.o = na.n and o.o = nb.n as same from o join n na on na.doc_id = o.a join n nb on nb.doc_id = o.b
  where o.o >= 0.8 * (na.n + nb.n - o.o) - 1e-9),
reach(doc_id, r) as (
  select doc_id, doc_id from documents union select reach.doc_id, l.b from reach join l on reach.r = l.a),
c as (select doc_id, min(r) as class_id from reach group by doc_id),
k as (select a, count(*) as n, min(b) filter (same) as twin from l group by a)
select c.doc_id, coalesce(k.n, 0) as n_links, c.class_id, least(c.doc_id, k.twin) as copy_of, c.doc_id = c.class_id as kept
from c left join k on k.a = c.doc_id
"""

# The patterns of the base kinds, and what confirms a match m.
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_DOUBLED = f"cast({_DIGITS}[length({_DIGITS}) - i + 1] as int) * (2 - i % 2)"
_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (
        r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "list_max([cast(p as hugeint) for p in string_split(m, '.')]) <= 255",
    ),
    "card": (
        r"[0-9](?:[\x20-]?[0-9])+",
        f"length({_DIGITS}) between 14 and 19 and list_sum([{_DOUBLED} - if({_DOUBLED} > 9, 9, 0)"
        f" for i in range(1, length({_DIGITS}) + 1)]) % 10 = 0",
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 10 and 15"),
}


def _spans_sql() -> str:
    found = []
    for order, (kind, (pattern, valid)) in enumerate(_KINDS.items()):
        found.append(f"""
  select doc_id, '{kind}' as kind, {order} as nth, h[i] as m,
    list_sum([length(x) for x in p[1:i]]) + coalesce(list_sum([length(x) for x in h[1 : i - 1]]), 0) as start
  from (select doc_id, p, h, unnest(range(1, len(h) + 1)) as i from (
    select doc_id, string_split_regex(text, '{pattern}') as p, regexp_extract_all(text, '{pattern}') as h
    from documents where text is not null))""")
    tests = " ".join(f"when '{kind}' then {valid}" for kind, (_, valid) in _KINDS.items())
    counts = ", ".join(f"count(f.kind) filter (f.kind = '{k}') as n_{k}" for k in _KINDS)
    return f"""
with every as ({" union all ".join(found)}),
f as (select *, kind || ':' || cast(start as bigint) || ':' || cast(start as bigint) + length(m) as said
  from every where case kind {tests} end),
g as (select d.doc_id, {counts}, coalesce(string_agg(f.said, ',' order by f.start, f.nth), '') as spans
  from documents d left join f using (doc_id) group by d.doc_id)
select *, sha256(spans) as base_sha256 from g
"""


PERSONAL = _spans_sql()


def _licences_sql() -> str:
    """All starts at which a template's mandatory phrases stand, by trying every word of every text."""
    found = []
    for kind, group in (("base", BASE), ("notice", NOTICES)):
        for t in group:
            stands = " and ".join(f"w[o + {at + 1} : o + {at + len(p)}] = {p!r}" for at, p in t.phrases())
            first = t.phrases()[0][1]
            share = f"len([t for t in range({len(t.words)}) if w[o + t + 1] = {t.words!r}[t + 1]]) / {float(len(t.words))}"
            found.append(f"""
  select doc_id, '{t.label}' as label, '{kind}' as kind, o, {share} as share from (
    select doc_id, w, unnest([o for o in range(len(w)) if {stands}]) as o from words where list_contains(w, '{first[0]}'))""")
    return f"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
p as ({" union all ".join(found)}),
g as (
  select doc_id, count(*) filter (kind = 'base') as n_base, min(o) filter (kind = 'base') as first_word,
    max(o) filter (kind = 'base') as last_word, array_to_string(list_sort(list(distinct label)), ',') as labels,
    coalesce(array_to_string(list_sort(list(distinct label) filter (kind = 'base')), ','), '') as base_labels,
    max(share) as score
  from p group by doc_id)
select words.doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from words left join g on g.doc_id = words.doc_id
"""


LICENCES = _licences_sql()
