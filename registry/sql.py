"""DuckDB equivalents, composed from common table expressions.

Header and footer removal is written with windows over unnested lines here, not
as the class words that the Spark expressions use, so the two check each other.
"""

from __future__ import annotations

import re

from registry.views import END_LINE, START_LINE
from textloom.functions.boilerplate import FOOTER_STARTS, HEADER_STARTS
from textloom.functions.text import WS
from textloom.functions.tokens import PIECE

NL = "chr(10)"

def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"

def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"

def newlines(x: str) -> str:
    return f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"

def spaces(x: str) -> str:
    return f"regexp_replace({x}, ' +', ' ', 'g')"

def blank_lines(x: str) -> str:
    return f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"

def whitespace(x: str) -> str:
    return strip(blank_lines(spaces(newlines(x))))

def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {quote(PIECE)})"

def sentences(x: str) -> str:
    split = f"string_split_regex({x}, '[.!?]+(?:{WS}+|$)')"
    kept = f"list_filter(list_transform({split}, lambda s: {strip('s')}), lambda s: s <> '')"
    return f"CASE WHEN len({kept}) = 0 THEN [{x}] ELSE {kept} END"

def joined(x: str) -> str:
    """A list of numbers as text."""
    return f"array_to_string({x}, ',')"

def is_upper(x: str) -> str:
    return f"(regexp_matches({x}, '\\p{{Lu}}') AND NOT regexp_matches({x}, '[\\p{{Ll}}\\p{{Lt}}]'))"

def words(x: str) -> str:
    return f"len(string_split_regex({x}, '{WS}+'))"

def _starts(patterns) -> str:
    return quote("(?i)^(?:" + "|".join(patterns) + ")")

HEADER_TEST = (
    f"regexp_matches(s, {_starts(HEADER_STARTS)}) OR (length(s) < 80 AND {is_upper('s')} AND {words('s')} < 10) "
    "OR (contains(s, '@') AND (contains(lower(s), 'http') OR contains(lower(s), 'www')))"
)
FOOTER_TEST = (
    f"regexp_matches(s, {_starts(FOOTER_STARTS)}) OR (length(s) < 20 AND i <= 3 AND {is_upper('s')} AND {words('s')} <= 3)"
)

# name -> SQL; a name used in the text of another is pulled in before it.
CTES: dict[str, str] = {}

def line_cut(name: str, source: str, reverse: bool, test: str, long: int, hits: int, free: int) -> None:
    """``name``: source with its header (or, reversed, footer) lines removed."""
    at = "ls[len(ls) + 1 - i]" if reverse else "ls[i]"
    kept = f"ls[:len(ls) - cut]" if reverse else "ls[cut + 1:]"
    CTES[f"{name}_lines"] = (
        f"SELECT doc_id, i, {strip(at)} AS s FROM (SELECT doc_id, ls, unnest(range(1, 16)) AS i FROM "
        f"(SELECT doc_id, string_split(text, {NL}) AS ls FROM {source}) WHERE len(ls) > 15)"
    )
    CTES[f"{name}_kinds"] = (
        f"SELECT doc_id, i, CASE WHEN s = '' THEN 'E' WHEN {test} THEN 'X' "
        f"WHEN length(s) > {long} OR regexp_matches(s, '\\p{{Ll}}') THEN 'C' ELSE 'M' END AS k FROM {name}_lines"
    )
    CTES[f"{name}_hits"] = (
        "SELECT *, count(*) FILTER (WHERE k = 'X') OVER (PARTITION BY doc_id ORDER BY i "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hits FROM {name}_kinds"
    )
    CTES[f"{name}_stops"] = (
        f"SELECT *, min(i) FILTER (WHERE k = 'C' OR (k = 'M' AND hits >= {hits})) OVER (PARTITION BY doc_id) AS stop "
        f"FROM {name}_hits"
    )
    CTES[f"{name}_cuts"] = (
        f"SELECT doc_id, max(i) AS cut FROM {name}_stops WHERE i < coalesce(stop, 16) "
        f"AND (k = 'X' OR (k = 'E' AND i <= {free})) GROUP BY doc_id"
    )
    CTES[name] = (
        f"SELECT doc_id, source_file, CASE WHEN cut IS NULL THEN text ELSE array_to_string({kept}, {NL}) END AS text "
        f"FROM (SELECT *, string_split(text, {NL}) AS ls FROM {source}) LEFT JOIN {name}_cuts USING (doc_id)"
    )

def book_cut(name: str, source: str) -> None:
    def mark(word: str) -> str:
        return (
            f"list_filter(range(1, len(ls) + 1), lambda i: contains(upper(ls[i]), '*** {word} OF') "
            "AND contains(upper(ls[i]), 'PROJECT GUTENBERG'))"
        )

    CTES[name] = (
        f"SELECT doc_id, source_file, CASE WHEN a + 1 < b THEN array_to_string(ls[a + 1:b - 1], {NL}) ELSE text END AS text "
        f"FROM (SELECT *, {mark('START')}[1] AS a, {mark('END')}[-1] AS b "
        f"FROM (SELECT *, string_split(text, {NL}) AS ls FROM {source}))"
    )

CTES["docs"] = "SELECT doc_id, printf('%s_%06d.txt', source, doc_id) AS source_file, text FROM documents"
_BODY = f"regexp_replace(text, '([.!?]) ', '\\1' || {NL}, 'g')"

def _lines(*parts: str) -> str:
    return f" || {NL} || ".join(parts)

CTES["dirty"] = (
    "SELECT doc_id, source_file, CASE doc_id % 6 "
    f"WHEN 0 THEN {_lines(quote('https://example.org/item'), quote('Copyright 2024'), quote(''), quote('[Title]'), _BODY)} "
    f"WHEN 1 THEN {_lines(_BODY, quote(''), quote('Page 3 of 9'), quote('Copyright 2024'), quote('17'))} "
    f"WHEN 2 THEN {_lines(quote('The eBook of X'), quote(START_LINE), _BODY, quote(END_LINE), quote('The last line.'))} "
    f"WHEN 3 THEN replace(replace({_BODY}, ' ', '   '), {NL}, repeat(chr(13) || chr(10), 3)) "
    "WHEN 4 THEN CASE WHEN doc_id % 12 = 4 THEN '' ELSE '   ' END ELSE text END AS text FROM docs"
)
CTES["given"] = "SELECT * FROM dirty WHERE text <> ''"
book_cut("booked", "given")
line_cut("headed", "booked", False, HEADER_TEST, 20, 2, 5)
line_cut("footed", "headed", True, FOOTER_TEST, 30, 1, 3)
CTES["tidied"] = f"SELECT doc_id, source_file, {whitespace('text')} AS text FROM footed"
# The single steps, each on the dirty texts themselves.
book_cut("only_booked", "dirty")
line_cut("only_headed", "dirty", False, HEADER_TEST, 20, 2, 5)
line_cut("only_footed", "dirty", True, FOOTER_TEST, 30, 1, 3)
CTES["stats"] = (
    "SELECT g.doc_id, g.source_file, length(g.text) AS n0, length(b.text) AS n1, length(h.text) AS n2, "
    "length(f.text) AS n3, length(t.text) AS n4, t.text FROM given g JOIN booked b USING (doc_id) "
    "JOIN headed h USING (doc_id) JOIN footed f USING (doc_id) JOIN tidied t USING (doc_id)"
)

def chunk_characters(name: str, source: str, size: int, overlap: int) -> None:
    """``name``: doc_id, source_file, pos, text, token_count."""
    limit, keep = size * 4, overlap * 4
    fold = (
        "list_reduce(list_transform(ss, lambda s: {'closed': []::VARCHAR[], 'open': s, 'used': 0::BIGINT}), "
        f"lambda a, x: CASE WHEN a.open IS NOT NULL AND a.used + length(x.open) > {limit} THEN "
        "{'closed': list_append(a.closed, a.open), "
        f"'open': right(a.open, {keep}) || ' ' || x.open, "
        f"'used': (least(length(a.open), {keep}) + length(x.open) + 1)::BIGINT}} "
        "ELSE {'closed': a.closed, 'open': CASE WHEN a.open IS NULL THEN x.open ELSE a.open || ' ' || x.open END, "
        "'used': (a.used + length(x.open) + 1)::BIGINT} END, "
        "{'closed': []::VARCHAR[], 'open': NULL::VARCHAR, 'used': 0::BIGINT})"
    )
    CTES[f"{name}_folds"] = (
        f"SELECT doc_id, source_file, {fold} AS f FROM (SELECT doc_id, source_file, {sentences('text')} AS ss "
        f"FROM {source} WHERE {strip('text')} <> '')"
    )
    CTES[name] = (
        "SELECT doc_id, source_file, pos, ts[pos + 1] AS text, length(ts[pos + 1]) // 4 AS token_count FROM "
        "(SELECT doc_id, source_file, ts, unnest(range(0, len(ts))) AS pos FROM "
        f"(SELECT doc_id, source_file, list_append(f.closed, f.open) AS ts FROM {name}_folds))"
    )

_PIECES = "STRUCT(\"text\" VARCHAR, n BIGINT)[]"

def pack(source: str, size: int, overlap: int) -> str:
    """Packed chunks ``cs`` (list of text, n) of all texts of ``source``, whatever their length."""
    start = f"{{'closed': []::{_PIECES}, 'open': NULL::VARCHAR, 'tail': []::VARCHAR[], 'used': 0::BIGINT}}"
    fold = (
        f"list_reduce(list_transform(ss, lambda s: {{'closed': []::{_PIECES}, 'open': s, 'tail': {tokens('s')}, "
        f"'used': 0::BIGINT}}), lambda a, x: CASE WHEN a.open IS NOT NULL AND a.used + len(x.tail) > {size} THEN "
        "{'closed': list_append(a.closed, {'text': a.open, 'n': a.used}), "
        "'open': array_to_string(a.tail, '') || ' ' || x.open, "
        f"'tail': list_concat(a.tail, x.tail)[-{overlap}:], 'used': (len(a.tail) + len(x.tail))::BIGINT}} "
        "ELSE {'closed': a.closed, 'open': CASE WHEN a.open IS NULL THEN x.open ELSE a.open || ' ' || x.open END, "
        f"'tail': list_concat(a.tail, x.tail)[-{overlap}:], 'used': (a.used + len(x.tail))::BIGINT}} END, {start})"
    )
    return (
        "SELECT doc_id, source_file, text, list_append(f.closed, {'text': f.open, 'n': f.used}) AS cs FROM "
        f"(SELECT doc_id, source_file, text, {fold} AS f FROM "
        f"(SELECT doc_id, source_file, text, {sentences('text')} AS ss FROM {source}))"
    )

def windows(source: str, size: int, overlap: int) -> str:
    """Window chunks ``cs`` of all texts of ``source``."""
    step = size - overlap
    starts = f"range(0, greatest(ceil((len(ts) - {size}) / {step}.0)::BIGINT, 0) * {step} + 1, {step})"
    cut = f"ts[w + 1:w + {size}]"
    return (
        f"SELECT doc_id, source_file, text, list_transform({starts}, "
        f"lambda w: {{'text': array_to_string({cut}, ''), 'n': len({cut})::BIGINT}}) AS cs FROM "
        f"(SELECT doc_id, source_file, text, {tokens('text')} AS ts FROM {source})"
    )

def chunk_tokens(name: str, source: str, size: int = 512, overlap: int = 50) -> None:
    """``name``: doc_id, source_file, pos, text, token_count."""
    CTES[f"{name}_texts"] = (
        f"SELECT *, len({tokens('text')}) AS n FROM (SELECT doc_id, source_file, text FROM {source}) "
        f"WHERE {strip('text')} <> ''"
    )
    CTES[f"{name}_long"] = f"SELECT doc_id, source_file, text FROM {name}_texts WHERE n > {size}"
    CTES[f"{name}_packed"] = pack(f"{name}_long", size, overlap)
    CTES[f"{name}_rest"] = f"SELECT doc_id, source_file, text FROM {name}_packed WHERE len(cs) < 2"
    CTES[f"{name}_lists"] = (
        f"SELECT doc_id, source_file, [{{'text': text, 'n': n::BIGINT}}] AS cs FROM {name}_texts WHERE n <= {size} "
        f"UNION ALL SELECT doc_id, source_file, cs FROM {name}_packed WHERE len(cs) > 1 "
        f"UNION ALL SELECT doc_id, source_file, cs FROM ({windows(f'{name}_rest', size, overlap)})"
    )
    CTES[name] = unnest_chunks(f"SELECT * FROM {name}_lists")

def unnest_chunks(lists: str) -> str:
    return (
        "SELECT doc_id, source_file, pos, cs[pos + 1].text AS text, cs[pos + 1].n AS token_count FROM "
        f"(SELECT doc_id, source_file, cs, unnest(range(0, len(cs))) AS pos FROM ({lists}))"
    )

def number(name: str, chunks: str) -> None:
    """``name``: the chunks with ids in document order."""
    CTES[name] = (
        "SELECT row_number() OVER (ORDER BY source_file, pos) - 1 AS chunk_id, source_file, pos, text, "
        f"length(text) AS text_length, token_count FROM {chunks}"
    )

def cut_split(name: str, source: str, hashed: str = "chunk_id") -> None:
    """``name``: source with ``split`` by the order of md5('42:' + hashed)."""
    CTES[name] = (
        f"SELECT *, CASE WHEN r <= a THEN 'train' WHEN r <= a + b THEN 'validation' ELSE 'test' END AS split FROM "
        f"(SELECT *, row_number() OVER (ORDER BY md5('42:' || {hashed})) AS r, "
        "floor(count(*) OVER () * 0.8::DOUBLE)::BIGINT AS a, floor(count(*) OVER () * 0.1::DOUBLE)::BIGINT AS b "
        f"FROM {source})"
    )

def vocabulary(name: str, source: str, size: int, special: list[str]) -> None:
    listed = ", ".join(f"({quote(t)}, {i}, 0)" for i, t in enumerate(special))
    room = size - len(special)
    CTES[f"{name}_counts"] = (
        f"SELECT token, count(*) AS freq FROM (SELECT unnest({tokens('text')}) AS token FROM {source}) GROUP BY token"
    )
    CTES[name] = (
        f"SELECT * FROM (VALUES {listed}) v(token, id, freq) UNION ALL SELECT token, "
        f"row_number() OVER (ORDER BY freq DESC, token) + {len(special) - 1} AS id, freq FROM "
        f"(SELECT * FROM {name}_counts ORDER BY freq DESC, token LIMIT {room})"
    )

def encode(name: str, source: str, vocab: str, unknown: int, key: str = "chunk_id", max_length: int = 1024) -> None:
    """``name``: key and ``ids``."""
    CTES[f"{name}_pieces"] = (
        f"SELECT {key}, i, ts[i] AS token FROM (SELECT {key}, ts, unnest(range(1, len(ts) + 1)) AS i FROM "
        f"(SELECT {key}, {tokens('text')}[:{max_length}] AS ts FROM {source}))"
    )
    CTES[name] = (
        f"SELECT {key}, list(coalesce(id, {unknown}) ORDER BY i) AS ids FROM {name}_pieces "
        f"LEFT JOIN {vocab} USING (token) GROUP BY {key}"
    )

def compose(final: str) -> str:
    """``final`` with the expressions it needs, directly or through others, in front."""

    names = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")
    order: list[str] = []

    def need(sql: str) -> None:
        # Only names after FROM or JOIN are table names.
        for found in re.findall(r"(?:FROM|JOIN)\s+(\w+)", sql):
            if found in CTES and found not in order:
                need(CTES[found])
                if found not in order:
                    order.append(found)

    need(final)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + final
