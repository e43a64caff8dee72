"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """The CRC-32 of a text's UTF-8 bytes up to U+00FF, bit by bit; the two numbers are its fixed values."""
    split = f"list_transform(string_split({text}, ''), lambda x: unicode(x)::bigint)"
    codes = f"flatten(list_transform({split}, lambda x: case when x < 128 then [x] else [192 + x // 64, 128 + x % 64] end))"
    step = (
        "list_reduce(list_prepend(xor(c, b), range(8)), "
        "lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
    )
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda c, b: {step}), 4294967295)"


def _leaf(text: str) -> str:
    fields = [
        f"case when {c} is null then '-' else octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar end"
        for c in ("doc_id", "source", "lang", "n_chars", text)
    ]
    return f"sha256({' || '.join(fields)})"


# What separates words.
_SPACE = r"\x20\x09-\x0D"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(percent: int) -> str:
    """CTEs up to ``groups`` (doc_id, n_shingles, component_id) of documents linked from that similarity on."""
    return rf"""
        split as (select doc_id, regexp_extract_all({_LOW}, '[^{_SPACE}]+') as ws from documents),
        spread as (select doc_id, unnest(ws) as word, unnest(range(len(ws))) as i from split),
        windows5 as (
            select doc_id, word, {", ".join(f"lead(word, {k}) over w as w{k}" for k in range(1, 5))}
            from spread window w as (partition by doc_id order by i)
        ),
        shingles as materialized (
            select distinct doc_id, concat_ws(' ', word, w1, w2, w3, w4) as one from windows5 where w4 is not null
            union all
            select doc_id, array_to_string(ws, ' ') from split where len(ws) between 1 and 4
        ),
        sized as materialized (
            select d.doc_id, count(one) as n from documents d left join shingles s on s.doc_id = d.doc_id group by d.doc_id
        ),
        common as (
            select a.doc_id as a, b.doc_id as b, count(*) as i
            from shingles a join shingles b on a.one = b.one and a.doc_id <> b.doc_id group by all
        ),
        links as materialized (
            select c.a, c.b from common c join sized x on x.doc_id = c.a join sized y on y.doc_id = c.b
            where 100 * i >= {percent} * (x.n + y.n - i)
        ),
        reach(doc_id, other) as (
            select doc_id, doc_id from documents
            union
            select r.doc_id, l.b from reach r join links l on l.a = r.other
        ),
        groups as materialized (
            select r.doc_id, any_value(z.n) as n_shingles, min(other) as component_id
            from reach r join sized z on z.doc_id = r.doc_id group by r.doc_id
        )"""


ORACLE = {
    # Full sets of all documents, compared by their common shingles.
    "op4_superminhash": f"""
        with recursive {_components(85)}
        select doc_id, n_shingles, component_id, doc_id = component_id as kept from groups
    """,
    # Documents that have a line, copies from 90 % on once.
    "op7_line_frequency": rf"""
        with recursive {_components(90)},
        texts as (select doc_id, source, coalesce(text, '') as text from documents),
        words as materialized (
            select doc_id, unnest(ws) as word, unnest(range(len(ws))) as i
            from (select doc_id, regexp_extract_all(text, '[^{_SPACE}]+') as ws from texts)
        ),
        grams as (
            select doc_id, i, word || ' ' || lead(word) over w || ' ' || lead(word, 2) over w as gram
            from words window w as (partition by doc_id order by i)
        ),
        again as (
            select doc_id, i from (select *, count(*) over (partition by doc_id, gram) as k from grams where gram is not null)
            where k > 1
        ),
        repeated as materialized (
            select doc_id, count(distinct i + d) as n_repeat_words from again, (select unnest([0, 1, 2]) as d) group by doc_id
        ),
        lines as (
            select doc_id, source, line,
                array_to_string(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{_SPACE}]+'), ' ') as norm,
                len(regexp_extract_all(line, '[^{_SPACE}]+')) as k
            from (select doc_id, source, unnest(string_split(text, chr(10))) as line from texts)
        ),
        full_lines as materialized (select * from lines where k > 0),
        dup as materialized (select doc_id, count(*) - count(distinct line) as n_dup_lines from full_lines group by doc_id),
        base as materialized (
            select t.doc_id, t.source, count(w.word) as n_words, coalesce(sum(length(w.word)), 0)::bigint as word_chars, n_symbols
            from (select doc_id, source, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols from texts) t
            left join words w on w.doc_id = t.doc_id group by t.doc_id, t.source, n_symbols
        ),
        told as materialized (
            select b.doc_id, b.source, case when n_words > 0 then component_id end as one from base b join groups g on g.doc_id = b.doc_id
        ),
        hosts as (select source, count(distinct coalesce(one, -1)) as host_docs from told group by source),
        frequent as (
            select l.source, norm from full_lines l join told t on t.doc_id = l.doc_id join hosts h on h.source is not distinct from l.source
            group by l.source, norm having count(distinct one) > greatest(20, 0.02 * any_value(host_docs))
        ),
        removed as materialized (
            select doc_id, sum(k)::bigint as n_removed_words from full_lines l
            join frequent f on f.source is not distinct from l.source and f.norm = l.norm group by doc_id
        ),
        verdicts as (
            select b.doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
                coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_removed_words, 0) as n_removed_words
            from base b left join dup using (doc_id) left join repeated using (doc_id) left join removed using (doc_id)
        )
        select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
            not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_words - n_removed_words >= 0.5 * n_words as kept
        from verdicts
    """,
    # Windows by their words, and the words that a window found in an earlier document covers.
    "op13_doubled_windows": rf"""
        with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') as ws from documents),
        windows as (
            select doc_id, i, array_to_string(ws[i : i + 49], ' ') as w
            from (select doc_id, ws, unnest(range(1, greatest(1, len(ws) - 48))) as i from texts)
        ),
        owned as (select doc_id, i, min(doc_id) over (partition by w) as first from windows),
        gone as (select distinct doc_id, i + k as i from owned, (select unnest(range(50)) as k) where first < doc_id),
        words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from texts),
        left_over as (
            select w.doc_id, count(*) filter (g.i is not null) as n_removed,
                string_agg(word, ' ' order by w.i) filter (g.i is null) as kept
            from words w left join gone g on g.doc_id = w.doc_id and g.i = w.i group by w.doc_id
        )
        select t.doc_id, len(ws) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
        from texts t left join left_over using (doc_id)
    """,
    # Levels from the leaves up, then the siblings of every leaf, then each proof folded.
    "op11_merkle_manifest": f"""
        with recursive docs as (
            select *, case when {_crc32("doc_id::varchar")} % 2 = 0 then replace(text, chr(10), '') else text end as found
            from documents
        ),
        leaves as (
            select doc_id, coalesce('s' || source, '') as src, {_leaf("text")} as leaf, {_leaf("found")} as again,
                row_number() over (partition by source order by doc_id) - 1 as pos,
                count(*) over (partition by source) as total
            from docs
        ),
        low(src, lvl, pos, total, h) as (
            select src, 0, pos, total, leaf from leaves
            union all
            select src, lvl + 1, pos // 3, (any_value(total) + 2) // 3, sha256(string_agg(h, '' order by pos))
            from low where total > 1 group by src, lvl, pos // 3
        ),
        subroots as (select src, h as subroot, row_number() over (order by src) - 1 as spot, count(*) over () as total from low where total = 1),
        high(lvl, pos, total, h) as (
            select 0, spot, total, subroot from subroots
            union all
            select lvl + 1, pos // 3, (any_value(total) + 2) // 3, sha256(string_agg(h, '' order by pos))
            from high where total > 1 group by lvl, pos // 3
        ),
        -- Where each leaf's branch stands on every level below a root.
        branch(doc_id, src, lvl, pos, total, up) as (
            select doc_id, src, 0, pos, total, 0 from leaves
            union all
            select doc_id, src, lvl + 1, pos // 3, (total + 2) // 3, 0 from branch where total > 1
        ),
        climb as (
            select b.doc_id, b.lvl as step,
                string_agg(n.h, '' order by n.pos) filter (n.pos < b.pos) as l, string_agg(n.h, '' order by n.pos) filter (n.pos > b.pos) as r
            from branch b join low n on n.src = b.src and n.lvl = b.lvl and n.pos // 3 = b.pos // 3
            where b.total > 1 group by b.doc_id, b.lvl
        ),
        source_branch(src, lvl, pos, total) as (
            select src, 0, spot, total from subroots
            union all
            select src, lvl + 1, pos // 3, (total + 2) // 3 from source_branch where total > 1
        ),
        source_climb as (
            select b.src, b.lvl as step,
                string_agg(n.h, '' order by n.pos) filter (n.pos < b.pos) as l, string_agg(n.h, '' order by n.pos) filter (n.pos > b.pos) as r
            from source_branch b join high n on n.lvl = b.lvl and n.pos // 3 = b.pos // 3
            where b.total > 1 group by b.src, b.lvl
        ),
        steps as (
            select doc_id, step, coalesce(l, '') as l, coalesce(r, '') as r from climb
            union all
            select doc_id, 1000 + step, coalesce(l, ''), coalesce(r, '') from leaves join source_climb using (src)
        ),
        numbered as (select *, row_number() over (partition by doc_id order by step) as k from steps),
        folds(doc_id, k, h) as (
            select doc_id, 0, again from leaves
            union all
            select f.doc_id, n.k, sha256(n.l || f.h || n.r) from folds f join numbered n on n.doc_id = f.doc_id and n.k = f.k + 1
        ),
        folded as (select doc_id, arg_max(h, k) as folded_root from folds group by doc_id),
        proofs as (select doc_id, string_agg(l || r, '' order by step) as proof from steps group by doc_id)
        select l.doc_id, l.leaf, s.subroot, t.h as root, sha256(coalesce(p.proof, '')) as proof_sha256,
            f.folded_root, f.folded_root = t.h as verified
        from leaves l join subroots s using (src) join high t on t.total = 1
            join folded f using (doc_id) left join proofs p using (doc_id)
    """,
    # Replaced: equal without the code point at one place. Deleted: equal to the other without one.
    "op12_search_schemes": f"""
        with recursive runs as (
            select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) as run from documents
        ),
        lowered as (
            select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as k
            from runs where length(run) >= 7 group by all
        ),
        hashed as (select run, k, {_crc32("coalesce(doc_id::varchar, '') || ':' || run")} as h from lowered),
        slipped as (
            select case when h % 31 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word, k
            from hashed
        ),
        words as (select word, sum(k)::bigint as n from slipped where length(word) >= 7 group by word having sum(k) >= 2),
        cut as (
            select word, n, i, word[1:i] || word[i + 2:] as rest from (select *, unnest(range(length(word))) as i from words)
        ),
        pairs as (
            select a.word, a.n, b.word as near, b.n as near_n from cut a join cut b
                on a.i = b.i and a.rest = b.rest and a.word <> b.word and length(a.word) = length(b.word)
            union
            select c.word, c.n, w.word, w.n from cut c join words w on c.rest = w.word
            union
            select w.word, w.n, c.word, c.n from cut c join words w on c.rest = w.word
        ),
        best as (
            select word, count(*) as n_near, arg_max(near, near_n) filter (near_n = top and near = low) as near, max(near_n) as near_n
            from (
                select *, min(near) filter (near_n = top) over (partition by word) as low
                from (select *, max(near_n) over (partition by word) as top from pairs)
            ) group by word
        ),
        told as (
            select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * w.n then near end as form,
                case when near_n >= 10 * w.n then near_n end as form_n
            from words w left join best using (word)
        ),
        walk(word, here, step) as (
            select word, word, 0 from told
            union all
            select k.word, t.form, step + 1 from walk k join told t on t.word = k.here where t.form is not null
        ),
        ends as (select word, arg_max(here, step) as root from walk group by word)
        select word, form, root, n, n_near, form_n from told join ends using (word)
    """,
    # The row that stays, from the normalised text itself.
    "op8_block_naming": r"""
        with t as (
            select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
            from documents
        )
        select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
            doc_id = min(doc_id) over g as kept, text_sha256
        from t window g as (partition by text_sha256)
    """,
}
