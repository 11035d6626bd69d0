"""SQL for the operators that SQL can express."""

from __future__ import annotations

from tidestream.llm.license_scan import SHINGLE_WORDS, TEMPLATES, window_plan


def _license_sql() -> str:
    """Every window of every document against every notice, by joining their shingles."""
    names = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES.items())
    lengths = ", ".join(f"({m}, {length}, {step})" for m in range(1, 401) for length, step, _ in [window_plan(m)])
    return f"""
with notices as (
  select license, ws, least(len(ws), {SHINGLE_WORDS}) as size
  from (select license, regexp_extract_all(lower(body), '[a-z0-9]+') as ws from (values {names}) as n(license, body)) as w),
wanted as (
  select distinct license, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) as sh
  from notices),
shapes as (
  select license, m, length, step from (select license, count(*) as m from wanted group by license) as c
  join (values {lengths}) as p(m, length, step) using (m)),
have as (
  select doc_id, size,
    unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) as sh,
    unnest(range(len(ws) - size + 1)) as pos
  from (select doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') as ws from documents) as w,
       (select distinct size from notices) as s where len(ws) >= size),
hits as (
  select doc_id, license, m, length, size, sh,
    unnest(range(cast(ceil(greatest(pos - length + 1, 0) / step) as bigint), pos // step + 1)) * step as start
  from have join wanted using (size, sh) join shapes using (license)),
windows as (
  select doc_id, license, length, size, start, count(distinct sh) / m as containment
  from hits group by doc_id, license, m, length, size, start)
select doc_id, license, containment, start as first_word, start + length + size - 2 as last_word
from (select *, row_number() over (partition by doc_id, license order by containment desc, start) as place
      from windows where containment >= 0.8) as best where place = 1"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), '{u}', '{l}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(u=_UPPER, l=_UPPER.lower())


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Codebooks round by round: each an assignment of all parts and the means of what was assigned."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as (
  select id, vec_id, label, p, v, best.e as e, best.d as d from (
    select x.id, x.vec_id, x.label, x.p, x.v, min({{'d': list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': c.e}}) as best
    from x join c{r} as c using (p) group by x.id, x.vec_id, x.label, x.p, x.v) as n)""")
        if r < rounds:
            steps.append(f"""
m{r} as (
  select p, e, list(cast((s - ((s % n) + n) % n) // n as bigint) order by k) as v
  from (select p, e, k, sum(y) as s, count(*) as n from (select p, e, unnest(v) as y, unnest(range(len(v))) as k from a{r}) as u group by p, e, k) as t
  group by p, e),
c{r + 1} as (select c.p, c.e, coalesce(m.v, c.v) as v from c{r} as c left join m{r} as m using (p, e))""")
    return f"""
with kept as (
  select row_number() over (order by vec_id) - 1 as id, vec_id, label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
x as (
  select id, vec_id, label, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] as v
  from kept, (select unnest(range({parts})) as p) as parts),
c0 as (select p, id as e, v from x where id < {entries}),{",".join(steps)},
books as (
  select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) as codebooks_sha256 from c{rounds}),
codes as (
  select id, vec_id, label, lower(string_agg(printf('%02x', e), '' order by p)) as code, cast(sum(d) as bigint) as error
  from a{rounds} group by id, vec_id, label)
select vec_id, label, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from codes, books"""


ORACLE = {
    "op11_vector_codes": _codes_sql(),
    "op12_ranked_search": rf"""
with words as (select doc_id, {_TERMS} as ws from documents),
sizes as (select doc_id, len(ws) as n from words where len(ws) > 0),
whole as (select count(*) as docs, cast(sum(n) as bigint) as total from sizes),
tf as (select doc_id, term, count(*) as tf from (select doc_id, unnest(ws) as term from words) as w group by doc_id, term),
df as (select term, count(*) as df from tf group by term),
weights as (select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w from df, whole),
asked as (select item_id, unnest({_TERMS}) as term from benchmark),
scores as (
  select item_id, doc_id,
    cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // total))))) as bigint) as score
  from asked join tf using (term) join weights using (term) join sizes using (doc_id), whole
  group by item_id, doc_id),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scores where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10""",
    "op3_license_scan": _license_sql(),
    "op5_jaccard_join": rf"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
  from documents),
s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as sh
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from s as a join s as b on a.sh = b.sh and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
links as (
  select x, y from shared join n as nx on nx.doc_id = x join n as ny on ny.doc_id = y
  where 100 * c >= 80 * (nx.n + ny.n - c)),
reach as (
  select doc_id, doc_id as root from documents
  union
  select y, root from reach join links on x = reach.doc_id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, r.component_id
from documents as d left join n using (doc_id)
join (select doc_id, min(root) as component_id from reach group by doc_id) as r using (doc_id)""",
    "op2_line_dedup": r"""
with lines as (
  select doc_id, coalesce('s' || source, 'none') as site, unnest(string_split(text, chr(10))) as line,
         unnest(range(len(string_split(text, chr(10))))) as pos
  from documents where text is not null),
keyed as (select *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) as bare from lines),
wide as (
  select bare from keyed where bare <> ''
  group by bare having count(distinct site) >= 10),
kept as (
  select doc_id, count(*) as lines, count(*) filter (where w.bare is not null) as removed,
         coalesce(string_agg(line, chr(10) order by pos) filter (where w.bare is null), '') as cleaned
  from keyed left join wide w using (bare) group by doc_id)
select d.doc_id, coalesce(lines, 0) as lines, coalesce(removed, 0) as removed,
       coalesce(length(cleaned), 0) as cleaned_chars, sha256(coalesce(cleaned, '')) as cleaned_sha256
from documents d left join kept using (doc_id)""",
    "op4_exact_dedup": r"""
with n as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over (partition by text_sha256) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id = min(doc_id) over (partition by text_sha256) as kept, text_sha256
from n""",
}
