"""SQL of the WARC and mixing queries."""

from __future__ import annotations

from nodeloom.llm.mixing import WEIGHTS

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def warc_sql() -> str:
    """A SHA-1 is eight groups of five hexadecimal digits; each gives four base-32 letters."""
    letter = lambda g, k: f"substr('{_ALPHABET}', ((('0x' || substr(d, {5 * g + 1}, 5))::bigint >> {15 - 5 * k}) & 31)::int + 1, 1)"
    base32 = " || ".join(letter(g, k) for g in range(8) for k in range(4))
    return f"""
        with p as (select page_id, coalesce(html, '') as h, sha1(coalesce(html, '')) as d from pages),
        f as (select *, min(page_id) over (partition by d) as first_id from p)
        select page_id, strlen(h)::bigint as payload_bytes, {base32} as payload_digest,
               case when page_id = first_id then 'response' else 'revisit' end as record_type, case when page_id <> first_id then first_id end as refers_to
        from f
    """


def mixing_sql(share: float = 1.5, most_epochs: int = 2, seed: int = 17) -> str:
    weights = ", ".join(map(str, WEIGHTS))
    return f"""
        with d as (select doc_id, source, length(coalesce(text, '')) as chars, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0b\\f\\r]+'))::bigint as size from documents),
        k as (select *, -ln((('0x' || substr(sha256(doc_id || ':{seed}'), 1, 13))::bigint + 0.5) / 4503599627370496.0)
                        / (case when chars / greatest(size, 1) between 3 and 10 then 1.0 when chars / greatest(size, 1) between 2 and 20 then 0.5 else 0.25 end) as key from d),
        s as (select source, sum(size)::bigint as source_size, list_extract([{weights}], ((row_number() over (order by encode(source) nulls last) - 1) % {len(WEIGHTS)} + 1)::int)::double as weight from k group by source),
        o as (select *, {most_epochs} * source_size as lim, sum(source_size) over () * {share} as budget,
                     coalesce(sum({most_epochs} * source_size) over w, 0) as stopped, sum(weight) over () - coalesce(sum(weight) over w, 0) as open, row_number() over (order by {most_epochs} * source_size / weight, source nulls last) as place
              from s window w as (order by {most_epochs} * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
        l as (select *, (budget - stopped) / open as own from o),
        t as (select source, source_size, least(lim, coalesce((select arg_min(own, place) from l where own * weight <= lim) * weight, lim))::double as target from l),
        e as (select *, floor(case when source_size > 0 then target / source_size else 0 end + 1e-12)::bigint as epochs from t),
        r as (select k.doc_id, k.size, e.source_size, e.target, e.epochs, greatest(e.target - e.epochs * e.source_size, 0) as rest, sum(k.size) over (partition by k.source order by k.key, k.doc_id rows between unbounded preceding and current row) as run
              from k join e on k.source is not distinct from e.source)
        select doc_id, size, source_size, target, (size * (epochs + case when epochs < {most_epochs} and rest > 0 and run - size / 2 <= rest then 1 else 0 end))::bigint as taken from r
    """
