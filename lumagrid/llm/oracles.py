"""DuckDB counterparts of those queries that SQL can express."""

from __future__ import annotations

from lumagrid.llm import sharding, url_filter


def _url_filter() -> str:
    def listed(values) -> str:
        return ", ".join(values)

    strict = listed(f"('{t}')" for t in url_filter.STRICT_TERMS)
    soft = listed(f"('{t}', {w}::double)" for t, w in url_filter.SOFT_TERMS.items())
    rules = listed(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)
    upper = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    hit = r"regexp_matches(low, '(^|[^\p{L}\p{N}])' || term || '($|[^\p{L}\p{N}])')"
    return rf"""
    with strict(term) as (values {strict}),
    soft(term, weight) as (values {soft}),
    rules(rule_host, rule_path, rule_verdict) as (values {rules}),
    rest as (
      select page_id, translate(coalesce(url, ''), {upper}) low,
        case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end rest
      from pages),
    parts as (
      select page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), {upper}) host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path
      from rest),
    fit as (
      select page_id, arg_max(rule_host || rule_path, len(rule_host || rule_path)) rule,
        arg_max(rule_verdict, len(rule_host || rule_path)) rule_verdict
      from parts, rules
      where (host = rule_host or ends_with(host, '.' || rule_host))
        and starts_with(path, rule_path)
      group by page_id),
    hard as (
      select page_id, string_agg(term, ',' order by term) terms from parts, strict where {hit} group by page_id),
    mild as (
      select page_id, string_agg(term, ',' order by term) terms, sum(weight) weight
      from parts, soft where {hit} group by page_id)
    select p.page_id, host, path, rule,
      coalesce(rule_verdict,
        case when h.terms is not null or m.weight >= {url_filter.SOFT_LIMIT} then 'block'
        else 'allow' end) verdict,
      coalesce(h.terms, '') strict_terms, coalesce(m.terms, '') soft_terms,
      coalesce(m.weight, 0)::double soft_weight
    from parts p left join fit using (page_id) left join hard h using (page_id)
      left join mild m using (page_id)
    """


_LINE_DEDUP = """
    with split as (
      select doc_id, string_split(coalesce(text, ''), chr(10)) lines from documents),
    lines as (
      select doc_id, unnest(lines) line, generate_subscripts(lines, 1) i from split),
    keyed as (
      select *, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k
      from lines),
    firsts as (
      select k, min(doc_id) first from keyed where len(k) >= 10
      group by k having min(doc_id) < max(doc_id)),
    judged as (
      select keyed.*, first is not null and first <> doc_id gone
      from keyed left join firsts using (k))
    select doc_id, count(*) n_lines, count(*) filter (where gone) n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) kept_sha256
    from judged group by doc_id
    """


_SPACE = r"[\x20\x09-\x0D]+"

_JACCARD = rf"""
    with recursive split as (
      select doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '{_SPACE}'), lambda w: w <> '') w
      from documents),
    sets as (
      select distinct doc_id, array_to_string(w[i + 1:i + 5], ' ') s
      from (select *, unnest(range(greatest(1, len(w) - 4))) i from split where len(w) > 0)),
    sizes as (select doc_id, count(*) n from sets group by doc_id),
    pairs as (
      select a.doc_id x, b.doc_id y, count(*) common
      from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
    links as (
      select x, y from pairs join sizes a on a.doc_id = x join sizes b on b.doc_id = y
      where 100 * common >= 80 * (a.n + b.n - common)),
    reached as (
      select doc_id, doc_id origin from documents
      union
      select y, origin from reached join links on x = reached.doc_id)
    select doc_id, coalesce(any_value(n), 0) n_shingles, min(origin) component_id
    from reached left join sizes using (doc_id) group by doc_id
    """

# Every window of every item's size that shares a shingle with the item, by exact similarity.
_LEAKS = rf"""
    with split_docs as (
      select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '{_SPACE}'),
        lambda w: w <> '') w
      from documents),
    split_items as (
      select min(item_id) item_id, count(*) n_items, w, len(w) length, least(5, len(w)) size
      from (select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '{_SPACE}'),
              lambda w: w <> '') w
            from benchmark)
      where len(w) > 0 group by w),
    entries as (
      select distinct item_id, size, length, array_to_string(w[i + 1:i + size], ' ') s
      from (select *, unnest(range(length - size + 1)) i from split_items)),
    weights as (
      select item_id, sum(len(replace(s, ' ', ''))) weight from entries group by item_id),
    runs as (
      select doc_id, size, i, array_to_string(w[i + 1:i + size], ' ') s, len(w) n
      from (select doc_id, w, size, unnest(range(len(w) - size + 1)) i
            from split_docs, (select distinct size from split_items) where len(w) >= size)),
    near as (
      select doc_id, item_id, any_value(n) n
      from (select distinct doc_id, item_id, n, s from runs join entries using (size, s))
      join weights using (item_id)
      group by doc_id, item_id
      having sum(len(replace(s, ' ', ''))) >= 0.8 * any_value(weight) - 0.001),
    starts as (
      select doc_id, item_id, size, length, least(length, n) n_words,
        unnest(range(greatest(1, n - length + 1))) start
      from near join split_items using (item_id)),
    window_sets as (
      select distinct t.doc_id, t.item_id, start, n_words, r.s
      from starts t join runs r on r.doc_id = t.doc_id and r.size = t.size
        and r.i between start and start + n_words - t.size),
    judged as (
      select x.doc_id, x.item_id, x.start, x.n_words,
        coalesce(sum(len(replace(x.s, ' ', ''))) filter (where e.s is not null), 0)::bigint common,
        sum(len(replace(x.s, ' ', '')))::bigint own
      from window_sets x left join entries e on e.item_id = x.item_id and e.s = x.s
      group by all),
    alike as (
      select doc_id, item_id, start, n_words, common::double / (weight::bigint + own - common)::double similarity
      from judged join weights using (item_id))
    select doc_id, item_id, n_items, start, n_words, similarity
    from (select *, row_number() over (partition by doc_id, item_id order by similarity desc, start) pos
          from alike where similarity >= 0.8)
    join (select item_id, n_items from split_items) using (item_id)
    where pos = 1
    """


# DuckDB has no crc32: the table of the polynomial, then a byte at a time.
_CRC_TABLE = """steps as (
      select i, list_reduce(list_prepend(i::bigint, range(8)), lambda c, k:
        case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) c
      from range(256) s(i)),
    lookup as (select list(c order by i) t from steps)"""


def _crc32(text: str) -> str:
    """CRC-32 of an expression where the table ``lookup`` is joined."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::bigint)"
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, {octets}),
        lambda c, x: xor(t[xor(c, x) % 256 + 1], c >> 8)), 4294967295)"""


_TRIE = f"""
    with {_CRC_TABLE},
    own as (
      select conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
        order by turn nulls first, sha256(
          strlen(coalesce(role, '')) || ':' || coalesce(role, '') || strlen(coalesce(text, '')) || ':' || coalesce(text, ''))) w
      from conversations where conv_id is not null group by conv_id),
    plan as (select conv_id, w, {_crc32("conv_id::varchar")} % 9 h from own, lookup),
    whole as (
      select p.conv_id, list_concat(coalesce(b.w[:h], []), p.w[h + 1:]) w
      from plan p left join own b on b.conv_id = p.conv_id - p.conv_id % 5),
    prefixes as (
      select conv_id, len(w) length, d, w[:d] p
      from (select *, unnest(range(len(w) + 1)) d from whole)),
    nodes as (
      select p, d, min(conv_id) conv_id, count(*) n_convs,
        sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where length = d), '')) ends_sha256,
        case when d = 0 then 0 else strlen(p[d].x) end * (count(*) - 1) saved
      from prefixes group by p, d),
    kids as (select p[:d - 1] p, count(*) n_children from nodes where d > 0 group by 1),
    shaped as (select nodes.*, coalesce(n_children, 0) n_children from nodes left join kids using (p)),
    sums as (
      select p[:a] p, count(*) filter (where n_children = 0) n_leaves, sum(saved)::bigint saved_tokens
      from (select *, unnest(range(d + 1)) a from shaped) group by 1)
    select c.conv_id, c.d depth, up.conv_id parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens,
      c.ends_sha256
    from shaped c join sums using (p) left join nodes up on c.d > 0 and up.p = c.p[:c.d - 1]
    """

# Words are near if they leave the same letters without one at the same place, or if one is the other without a letter.
_SPELLING = f"""
    with recursive {_CRC_TABLE},
    runs as (
      select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') run, count(*) n
      from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) run from documents)
      where len(run) >= 7 group by 1, 2),
    hashed as (select run, n, {_crc32("coalesce(doc_id::varchar, '') || ':' || run")} h from runs, lookup),
    spelled as (
      select case when h % 31 = 0 then run[:h % len(run)] || run[h % len(run) + 2:] else run end word, n from hashed),
    words as (select word, sum(n)::bigint n from spelled where len(word) >= 7 group by word having sum(n) >= 2),
    gaps as (
      select word, n, i, word[:i] || word[i + 2:] rest from (select *, unnest(range(len(word))) i from words)),
    near as (
      select a.word, b.word other, b.n from gaps a join gaps b using (i, rest) where a.word <> b.word
      union select g.word, w.word, w.n from gaps g join words w on w.word = rest
      union select w.word, g.word, g.n from gaps g join words w on w.word = rest),
    best as (
      select word, count(*) n_near, max(n) best_n, arg_max(other, struct_pack(n := n, k := -place)) best
      from (select *, row_number() over (partition by word order by other) place from near) group by word),
    marked as (
      select words.*, coalesce(n_near, 0) n_near,
        case when best_n >= 10 * words.n then best end form, case when best_n >= 10 * words.n then best_n end form_n
      from words left join best using (word)),
    followed as (
      select word, word top from words
      union all select f.word, form from followed f join marked m on m.word = f.top where form is not null)
    select m.word, m.form, f.top root, m.n, m.n_near, m.form_n
    from marked m join followed f on f.word = m.word join marked e on e.word = f.top and e.form is null
    """


def _rendezvous() -> str:
    draw = "(('0x' || substr(md5(doc_id || '#' || i), 1, 13))::bigint + 0.5::double) / (1::bigint << 52)"
    return f"""
    with {_CRC_TABLE},
    bytes as (
      select doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
        lambda b: ('0x' || b)::bigint) b
      from documents),
    sums as (
      select doc_id, len(b) + 16 size, xor(list_reduce(list_prepend(4294967295::bigint, b),
        lambda c, x: xor(t[xor(c, x) % 256 + 1], c >> 8)), 4294967295) text_crc32
      from bytes, lookup),
    draws as (select doc_id, i, {draw} u from documents, range(41) s(i)),
    placed as (
      select doc_id, arg_max(i, u) filter (where i < 40) shard, arg_max(i, u) grown_shard
      from draws group by doc_id)
    select doc_id, size, text_crc32, 'key' law, shard::int shard,
      row_number() over (partition by shard order by doc_id) - 1 slot,
      grown_shard::int grown_shard
    from sums join placed using (doc_id)
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": _url_filter(),
        "op3_line_dedup": _LINE_DEDUP,
        "op6_ngram_jaccard": _JACCARD,
        "op8_decontaminate": _LEAKS,
        "op9_rendezvous": _rendezvous(),
        "op11_prefix_trie": _TRIE,
        "op12_spelling_variants": _SPELLING,
    }
