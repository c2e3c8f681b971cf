"""The noise operators and profiles in DuckDB SQL: each step is a query over (doc_id, text) of the step before.

Draws are those of ``functions/rng.py``: murmur3 of positions, from an md5 of (seed, key, tag).
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from framewright.functions import augment

SEED = 7
M32 = 4294967295
_names = itertools.count()

WORDS = "list_filter(regexp_split_to_array({t}, '\\s+'), lambda w: w <> '')"
SENTENCES = "list_filter(list_transform(regexp_extract_all(text, '([^.!?]*[.!?]|[^.!?]+$)', 1), lambda s: trim(s, ' ' || chr(10))), lambda s: s <> '')"
LINES = "string_split(regexp_replace(text, '\\n$', ''), chr(10))"
JOIN = "chr(92) || 'n'"
GLUE = """array_to_string(list_transform(kept, lambda s, i: s || CASE WHEN i < len(kept) AND (NOT regexp_matches(s, '[.!?]$')
  OR regexp_matches(kept[i + 1], '^[\\p{L}\\p{N}]')) THEN ' ' ELSE '' END), '')"""


def let(value: str, body: Callable[[str], str]) -> str:
    """``body(name)`` with ``value`` bound to a name."""
    name = f"v{next(_names)}"
    return f"list_transform([{value}], lambda {name}: {body(name)})[1]"


def murmur(parts: list[str], seed: str = "42") -> str:
    """murmur3 of whole numbers, 32 bits each, one after the other, as an unsigned number; each has the one before as its seed."""
    mul = lambda x, c: f"((({x})::UBIGINT * {c}::UBIGINT) & {M32}::UBIGINT)"
    rotl = lambda x, r: let(x, lambda v: f"((({v} << {r}) | ({v} >> {32 - r})) & {M32}::UBIGINT)")
    shift = lambda x, r: let(x, lambda v: f"xor({v}, {v} >> {r})")
    mixed = lambda h, k: f"(({mul(rotl(f'xor({h}, {mul(rotl(mul(k, 0xCC9E2D51), 15), 0x1B873593)})', 13), 5)} + {0xE6546B64}::UBIGINT) & {M32}::UBIGINT)"
    final = lambda h, n: shift(mul(shift(mul(shift(f"xor({h}, {n}::UBIGINT)", 16), 0x85EBCA6B), 13), 0xC2B2AE35), 16)
    first, *rest = parts
    h = final(mixed(mixed(f"{seed}::UBIGINT", first), "0"), 8)  # a long: its low half, then its high half, which is 0 here
    for p in rest:
        h = final(mixed(h, p), 4)
    return h


def u(tag: str, i: str, *more: str) -> str:
    """A draw for a position; positions count from 0."""
    start = f"('0x' || substr(md5(concat_ws('|', '{SEED}', CAST(doc_id AS VARCHAR), '{tag}')), 1, 8))::UBIGINT"
    h = murmur([start, i, *more])
    return let(h, lambda v: f"(CASE WHEN {v} >= 2147483648 THEN {v}::BIGINT - 4294967296 ELSE {v}::BIGINT END / 4294967296.0 + 0.5)")


def whole(tag: str, i: str, low: str | int, high: str | int, *more: str) -> str:
    """A whole number from ``low`` to ``high``, both included."""
    return f"CAST({low} + floor({u(tag, i, *(more or ('1',)))} * (({high}) - ({low}) + 1)) AS INT)"


def _by_line(source: str, tag: str, p: float, hit: str, changed: str) -> str:
    """Lines with a hit changed: ``changed`` and ``hit`` may use s, i and the words w."""
    return f"""SELECT doc_id, CASE WHEN any_value(text) = '' THEN '' ELSE string_agg(CASE WHEN ({hit}) AND {u(tag, 'i')} < {p}::DOUBLE THEN {changed} ELSE s END, {JOIN} ORDER BY i) END AS text
      FROM (SELECT doc_id, text, z.s AS s, z.i AS i, {WORDS.format(t="z.s")} AS w FROM (SELECT doc_id, text, unnest(list_transform({LINES}, lambda s, i: {{'s': s, 'i': i - 1}})) AS z FROM {source}))
      GROUP BY doc_id"""


def _rfind(text: str, piece: str) -> str:
    """1-based place of the last occurrence; 0 if none."""
    return let(f"instr(reverse({text}), reverse({piece}))", lambda b: f"CASE WHEN {b} = 0 THEN 0 ELSE length({text}) - {b} - length({piece}) + 2 END")


def _start(line: str, n: str) -> str:
    part = f"array_to_string(w[1:{n}], ' ')"
    return let(part, lambda p: f"substr({line}, 1, length({p})) || ' ' || {p} || substr({line}, length({p}) + 1)")


def _end(line: str, n: str) -> str:
    def insert(acc: str, part: str) -> str:
        end = f"{_rfind(acc, f'{part}[-1]')} + length({part}[-1]) - 1"
        return let(_rfind(f"substr({acc}, 1, {end})", f"{part}[1]"), lambda k: f"CASE WHEN {k} = 0 THEN {acc} ELSE substr({acc}, 1, {k} - 1) || array_to_string({part}, ' ') || ' ' || substr({acc}, {k}) END")

    return let(line, lambda acc: let(f"w[len(w) - {n} + 1:]", lambda part: insert(acc, part)))


def _rounds(tag: str, low: float, high: float, most: int, once: Callable[[str, str], str]) -> str:
    """Rounds on one line, as many as drawn; each draws a number of words."""
    line = "s"
    for k in range(1, most + 1):
        n = f"least({whole(tag, 'i', int(low), int(high), '2', str(k))}, len(w))"
        line = let(line, lambda acc, n=n, k=k: f"CASE WHEN {whole(tag, 'i', 1, most)} >= {k} THEN {let(n, lambda m: once(acc, m))} ELSE {acc} END")
    return line


def _stretch(tag: str, low: float, high: float, most: int) -> str:
    def insert(k: str) -> str:
        ratio = f"({low}::DOUBLE + {u(tag, 'i', '2', k)} * {high - low!r}::DOUBLE)"
        size = f"CASE WHEN len(w) = 1 THEN 1 ELSE greatest(1, CAST(floor(len(w) * {ratio}) AS INT)) END"
        return let(size, lambda n: let(whole(tag, "i", 1, f"len(w) - {n} + 1", "3", k), lambda at: place(n, at)))

    def place(n: str, at: str) -> str:
        first = f"list_min(list_filter(range(1, len(w) - {n} + 2), lambda j: w[j:j + {n} - 1] = w[{at}:{at} + {n} - 1]))"
        return let(first, lambda j: f"array_to_string(list_concat(list_concat(w[1:{j} + {n} - 1], w[{at}:{at} + {n} - 1]), w[{j} + {n}:]), ' ')")

    return let(whole(tag, "i", 1, most), insert)


MISREAD = "MAP {" + ", ".join(f"'{k}': [{', '.join(repr(x) for x in v)}]" for k, v in augment.MISREADINGS.items()) + "}"


def step(op: str, args: tuple, tag: str, source: str) -> str:
    """One operator over the table ``source``; the operators' names are those of the profiles."""
    p = args[0]
    if op == "ds":
        kept = f"list_filter(s, lambda x, i: {u(tag, 'i - 1')} > {p}::DOUBLE)"
        return f"SELECT doc_id, CASE WHEN len(s) = 0 THEN text ELSE {GLUE} END AS text FROM (SELECT *, {kept} AS kept FROM (SELECT doc_id, text, {SENTENCES} AS s FROM {source}))"
    if op == "dw":
        return f"SELECT doc_id, array_to_string(list_filter({WORDS.format(t='text')}, lambda w, i: {u(tag, 'i - 1')} > {p}::DOUBLE), ' ') AS text FROM {source}"
    if op == "dl":
        again = f"list_transform(range(1 + CASE WHEN {u(tag, 'i - 1')} < {p}::DOUBLE THEN {whole(tag, 'i - 1', 1, int(args[1]))} ELSE 0 END), lambda r: s)"
        return f"SELECT doc_id, CASE WHEN text = '' THEN '' ELSE array_to_string(flatten(list_transform({LINES}, lambda s, i: {again})), {JOIN}) END AS text FROM {source}"
    if op == "ps":
        return _by_line(source, tag, p, "len(w) > 0", _rounds(tag, args[1], args[2], int(args[3]), _start))
    if op == "pe":
        return _by_line(source, tag, p, "len(w) > 0", _rounds(tag, args[1], args[2], int(args[3]), _end))
    if op == "pr":
        return _by_line(source, tag, p, "len(w) > 0", _stretch(tag, args[1], args[2], int(args[3])))
    if op == "sl":
        cut = let(whole(tag, "i", 1, "greatest(len(w) - 1, 1)"), lambda k: f"array_to_string(w[1:{k}], ' ') || {JOIN} || array_to_string(w[{k} + 1:], ' ')")
        return _by_line(source, tag, p, "len(w) > 1", cut)
    if op == "ml":
        hit = f"i < len(s) AND {u(tag, 'i - 1')} < {p}::DOUBLE"
        return f"""WITH RECURSIVE l AS (SELECT doc_id, text, {LINES} AS s FROM {source}),
          w AS (SELECT doc_id, 1 AS i, CAST([] AS VARCHAR[]) AS done, s FROM l
            UNION ALL
            SELECT doc_id, CASE WHEN {hit} THEN i + 2 ELSE i + 1 END, list_append(done, CASE WHEN {hit} THEN trim(s[i], ' ') || ' ' || trim(s[i + 1], ' ') ELSE s[i] END), s
            FROM w WHERE i <= len(s))
          SELECT w.doc_id, CASE WHEN len(w.s) < 2 THEN l.text ELSE array_to_string(done, {JOIN}) END AS text FROM w JOIN l USING (doc_id) WHERE i > len(w.s)"""
    if op == "ws":
        gap = let(u(tag, "i - 1"), lambda r: f"CASE WHEN {r} < {p}::DOUBLE THEN '' WHEN {r} < {p + args[1]!r}::DOUBLE THEN '  ' ELSE ' ' END")
        return f"""SELECT doc_id, array_to_string(list_transform(w, lambda x, i: CASE WHEN i = 1 THEN x WHEN w[i - 1] = '' OR x = '' THEN w[i - 1] || x ELSE {gap} || x END), '') AS text
          FROM (SELECT doc_id, string_split(text, ' ') AS w FROM {source})"""
    assert op == "ch"
    return f"""WITH k AS (SELECT doc_id, unnest(list_transform(string_split(text, ''), lambda c, i: {{'c': c, 'i': i - 1}})) AS z FROM {source} WHERE text <> ''),
      m(c, f) AS (SELECT c, coalesce(({MISREAD})[lower(c)], ({MISREAD})[c]) FROM (SELECT DISTINCT z.c AS c FROM k)),
      o AS (SELECT doc_id, z.i AS i, CASE WHEN f IS NOT NULL AND {u(tag, "z.i")} < {p}::DOUBLE THEN f[{whole(tag, "z.i", 1, "len(f)")}] ELSE z.c END AS c FROM k JOIN m ON m.c = z.c)
      SELECT doc_id, string_agg(c, '' ORDER BY i) AS text FROM o GROUP BY doc_id UNION ALL SELECT doc_id, text FROM {source} WHERE text = ''"""


def chain(name: str, source: str, prefix: str = "s") -> tuple[list[str], str]:
    """The steps of a profile as common table expressions, and the name of the last."""
    made = []
    for k, (op, *args) in enumerate(augment.PROFILES[name]):
        made.append(f"{prefix}{k} AS MATERIALIZED ({step(op, tuple(args), f'{name}:{k}:{op}', source)})")
        source = f"{prefix}{k}"
    return made, source


def profile(name: str, source: str = "documents") -> str:
    made, last = chain(name, source)
    return f"WITH {', '.join(made)} SELECT doc_id, text FROM {last}"


def chosen(key: str) -> str:
    """The number of the profile that is drawn for a key."""
    return f"CAST(floor((('0x' || substr(md5(concat_ws('|', '{SEED}', CAST({key} AS VARCHAR), 'profile', '0')), 1, 8))::BIGINT / 4294967296.0) * {len(augment.PROFILES)}) AS INT)"


def choice(source: str) -> tuple[list[str], str]:
    """Common table expressions that give every row of ``source`` (doc_id, text) the profile drawn for it; an empty text stays ''."""
    made, last = [], []
    for n, name in enumerate(augment.PROFILES):
        made.append(f"p{n} AS MATERIALIZED (SELECT doc_id, text FROM {source} WHERE {chosen('doc_id')} = {n})")
        steps, end = chain(name, f"p{n}", f"p{n}s")
        made += steps
        last.append(f"SELECT doc_id, text FROM {end}")
    made.append(f"chosen AS ({' UNION ALL '.join(last)})")
    return made, "chosen"
