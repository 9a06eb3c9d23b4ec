"""DuckDB SQL of the Merkle manifest and of the centroid clustering."""

FANOUT = 8
# The leaf rows of a tree that the SQL below can climb: 8 to the power of the levels.
LEVELS = 8


def _field(column):
    return f"coalesce(cast(strlen(cast({column} as varchar)) as varchar) || ':' || cast({column} as varchar), '-')"


def _leaf(text):
    return "sha256(" + " || ".join([*map(_field, ("doc_id", "source", "lang", "n_chars")), _field(text)]) + ")"


def _tree(name, leaves):
    """Tables ``name``0, 1, ... of the nodes of each level (tree, pos, n, h), trees of one node left out above it, and
    ``name``_roots. A run is the nodes with the same pos // 8."""
    parts = [f"{name}0 as (select tree, pos, count(*) over (partition by tree) n, h from ({leaves}))"]
    for k in range(1, LEVELS + 1):
        parts.append(f"""{name}{k} as (select tree, pos // {FANOUT} pos, count(*) over (partition by tree) n,
  sha256(string_agg(h, '' order by pos)) h from {name}{k - 1} where n > 1 group by tree, pos // {FANOUT})""")
    roots = " union all ".join(f"select tree, h from {name}{k} where n = 1" for k in range(LEVELS + 1))
    return ",\n".join([*parts, f"{name}_roots as ({roots})"])


def _climb(name, start):
    """``name``_up: each row of ``start`` (id, tree, pos, leaf, h, proof) with the siblings of its tree in proof and the
    root that they give in h."""
    parts = [f"{name}_up0 as ({start})"]
    for k in range(LEVELS):
        run = f"s.tree = u.tree and s.pos // {FANOUT} = u.pos // {FANOUT}"
        parts.append(f"""{name}_up{k + 1} as (
  select u.id, u.tree, u.pos // {FANOUT} pos, u.leaf,
    case when m.n > 1 then sha256(coalesce(b, '') || u.h || coalesce(a, '')) else u.h end h,
    case when m.n > 1 then u.proof || coalesce(b, '') || coalesce(a, '') else u.proof end proof
  from {name}_up{k} u left join (select tree, max(n) n from {name}{k} group by tree) m on m.tree = u.tree
  left join (select u.id, string_agg(s.h, '' order by s.pos) filter (where s.pos < u.pos) b,
      string_agg(s.h, '' order by s.pos) filter (where s.pos > u.pos) a
    from {name}_up{k} u join {name}{k} s on {run} where s.n > 1 group by u.id) g on g.id = u.id)""")
    return ",\n".join(parts)


# CRC-32, bit by bit over the decimal digits of the id.
_CRC = """xor(list_reduce(list_prepend(cast(4294967295 as bigint), flatten(list_transform(string_split(cast(doc_id as varchar), ''),
  lambda c: [cast(ascii(c) as bigint), 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, b: case when xor(a, b) % 2 = 1 then xor(xor(a, b) // 2, cast(3988292384 as bigint)) else xor(a, b) // 2 end), cast(4294967295 as bigint))"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = f"""
with docs as (
  select doc_id id, coalesce('v' || lang, 'n') tree, row_number() over (partition by lang order by doc_id) - 1 pos, {_leaf('text')} h,
    case when ({_CRC}) % 3 = 0 then {_leaf(_LOWER)} else {_leaf('text')} end other
  from documents),
{_tree('t', 'select tree, pos, h from docs')},
{_tree('top', "select '' tree, row_number() over (order by tree) - 1 pos, h from t_roots")},
{_climb('t', "select id, tree, pos, h leaf, other h, '' proof from docs")},
heads as (select tree, row_number() over (order by tree) - 1 pos, h from t_roots),
{_climb('top', f"select u.id, '' tree, heads.pos, u.leaf, u.h, u.proof from t_up{LEVELS} u join heads on heads.tree = u.tree")}
select u.id doc_id, u.leaf, s.h subroot, r.h root, sha256(u.proof) proof_sha256, u.h folded_root, u.h = r.h verified
from top_up{LEVELS} u join docs on docs.id = u.id join t_roots s on s.tree = docs.tree cross join top_roots r
"""

_CLUSTERS, _ROUNDS, _DIMENSIONS = 40, 5, 64


def _assigned(k):
    return f"""a{k} as (
  select vec_id, v, cluster, d from (
    select vec_id, v, cluster, d, row_number() over (partition by vec_id order by d, cluster) r from (
      select vec_id, kept.v, cluster, cast(list_sum([(kept.v[i] - c.v[i]) * (kept.v[i] - c.v[i]) for i in range(1, {_DIMENSIONS + 1})]) as bigint) d
      from kept cross join c{k} c)) where r = 1)"""


def _moved(k):
    return f"""c{k} as (
  select c.cluster, coalesce(m.v, c.v) v from c{k - 1} c left join (
    select cluster, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) v from (
      select cluster, i, cast(sum(x) as bigint) s, count(*) n from (
        select cluster, unnest(v) x, unnest(range(1, {_DIMENSIONS + 1})) i from a{k - 1}) group by cluster, i) group by cluster) m on m.cluster = c.cluster)"""


OP13_SQL = f"""
with kept as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v from embeddings
  where len(embedding) = {_DIMENSIONS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {_DIMENSIONS}),
c0 as (
  select row_number() over (order by h) - 1 cluster, v from (select sha256('2:' || cast(vec_id as varchar)) h, v from kept order by h limit {_CLUSTERS})),
{', '.join(f'{_assigned(k)}, {_moved(k + 1)}' for k in range(_ROUNDS))}, {_assigned(_ROUNDS)}
select vec_id, cast(a.cluster as integer) cluster, d distance, cast(sum(d) over (partition by a.cluster) as bigint) cluster_inertia,
  cast(sum(d) over () as bigint) inertia, sha256(list_aggregate(c.v, 'string_agg', ',')) centroid_sha256
from a{_ROUNDS} a join c{_ROUNDS} c on c.cluster = a.cluster
"""
