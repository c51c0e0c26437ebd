"""The license scan in SQL. Words are mapped one by one through a table, where the operator replaces strings."""

from __future__ import annotations

from nodeloom.llm.license import COPYRIGHT_LINE, KNOWN, PROSE, SPELLINGS, full_texts

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


#: RE2 has no look-ahead: a holder's line is told apart by the word behind "copyright" in a second test.
_SIGNED = r"^[ \t#*/;-]*(copyright[ \t:,]*(\(c\)|©|[<\[{(]?([0-9]{4}\b|y{2,4}\b|year\b)).*|(\(c\)|©).*|all rights reserved[ \t.]*)$"
_NAMED = r"^[ \t#*/;-]*copyright[ \t:]+[^.;]{1,80}\.?$"
_CONTINUED = rf"^[ \t#*/;-]*copyright[ \t:]+({'|'.join(PROSE)})\b"
_MAP = "map {" + ", ".join(f"'{said}': '{meant}'" for said, meant in SPELLINGS if " " not in said) + "}"


def _canonical(text: str) -> str:
    """Digest of the canonical form."""
    lines = f"list_filter(string_split(translate({text}, '{_UPPER}', '{_LOWER}'), chr(10)), lambda x: not regexp_matches(x, {_quote(_SIGNED)}) and not (regexp_matches(x, {_quote(_NAMED)}) and not regexp_matches(x, {_quote(_CONTINUED)})))"
    words = f"list_filter(regexp_split_to_array(array_to_string({lines}, chr(10)), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    form = f"' ' || array_to_string(list_transform({words}, lambda x: coalesce({_MAP}[x], x)), '  ') || ' '"
    for said, meant in SPELLINGS:
        if " " in said:
            form = f"replace({form}, ' {said.replace(' ', '  ')} ', ' {meant} ')"
    return f"sha256(replace(trim({form}), '  ', ' '))"


def scan_sql() -> str:
    """Every line of every text is looked up, and every text whole."""
    known = ", ".join(f"({_quote(name)}, {_quote(text)})" for name, text in [*KNOWN, *full_texts()])
    return f"""
        with d as (select doc_id, coalesce(text, '') as t from documents),
        units as (select 'known' as kind, null as doc_id, l, t from (values {known}) k(l, t) union all select 'whole', doc_id, null, t from d union all select 'line', doc_id, null, unnest(string_split(t, chr(10))) from d),
        forms as (select kind, doc_id, l, {_canonical('t')} as digest from units),
        known as (select digest, min(l) as license from forms where kind = 'known' group by 1),
        hits as (select doc_id, count(*) as n, string_agg(distinct license, ',' order by license) as notices from forms join known using (digest) where kind = 'line' group by 1)
        select w.doc_id, k.license, coalesce(h.n, 0)::bigint as n_notices, coalesce(h.notices, '') as notices, w.digest
        from forms w left join known k using (digest) left join hits h on h.doc_id = w.doc_id where w.kind = 'whole'
    """
