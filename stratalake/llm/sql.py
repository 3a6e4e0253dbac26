"""DuckDB SQL for the queries that it can say, over the whole given tables."""

from __future__ import annotations

_FOLDED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "coalesce(regexp_extract_all(" + _FOLDED + ", '{1}'), [])"
_ALNUM, _NOT_SPACE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x20\x09-\x0D]+"

DECONTAMINATION = f"""
    with d as (select doc_id, {_WORDS.format('text', _ALNUM)} as w from documents),
      b as (select coalesce(cast(item_id as varchar), '') as item, {_WORDS.format('text', _ALNUM)} as w from benchmark),
      p as (select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as s
        from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as u(i) where len(w) > 0),
      hit as (select doc_id, i, n, item from (
          select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as s
          from d, (select distinct n from p), unnest(range(1, len(w) - n + 2)) as u(i)) join p using (n, s)),
      covered as (select doc_id, count(distinct k) as n_hit from hit, unnest(range(i, i + n)) as u(k) group by 1),
      found as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hit group by 1)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
      sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join covered using (doc_id) left join found using (doc_id)"""

JACCARD_JOIN = f"""
    with recursive d as (select doc_id, {_WORDS.format('text', _NOT_SPACE)} as w from documents),
      s as (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as x
        from d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as u(i) where len(w) > 0),
      n as (select doc_id, count(*) as n from s group by 1),
      common as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b using (x) where a.doc_id <> b.doc_id group by 1, 2),
      link as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
      reach(a, b) as (select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a)
    select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(m, doc_id)) as component_id
    from d left join n using (doc_id) left join (select a as doc_id, min(b) as m from reach group by 1) using (doc_id)"""

SUFFIX_DEDUP = """
    with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
      starts as (select doc_id, i, md5(substr(h, 2 * i + 1, 800)) as p from d, unnest(range(0, n - 399)) as u(i)),
      again as (select p from starts group by 1 having count(*) > 1),
      edges as (select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 400 then 0 else 1 end as new from starts join again using (p)),
      runs as (select doc_id, min(i) as a, max(i) + 400 as b from (
          select doc_id, i, sum(new) over (partition by doc_id order by i) as g from edges) group by doc_id, g),
      cuts as (select doc_id, count(*) as n_spans, sum(b - a) as n_removed from runs group by 1),
      pieces as (select doc_id, lag(b, 1, 0) over (partition by doc_id order by a) as k, a as e from runs
        union all select doc_id, max(b), max(n) from runs join d using (doc_id) group by 1),
      kept as (select doc_id, string_agg(substr(h, 2 * k + 1, 2 * (e - k)), '' order by k) as h from pieces join d using (doc_id) group by 1)
    select doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans,
      sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256, n - cast(coalesce(n_removed, 0) as bigint) as n_kept, coalesce(n_removed, 0) > 0 as changed
    from d left join cuts using (doc_id) left join kept using (doc_id)"""

_CRC32 = ("xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(cast({0} as varchar), ''), lambda c: ascii(c))), "
          "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)))")

PERIODIC_RUNS = f"""
    with d as (select row_number() over () as k, doc_id, {_CRC32.format('doc_id')} as h, {_WORDS.format('text', _NOT_SPACE).replace(_FOLDED.format('text'), 'text')} as w from documents),
      a as (select *, h // 10 as g, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a from d),
      p as (select *, 1 + (len(w) - a) // (3 + g % 8) as p from a),
      r as (select k, doc_id, case when a is null then w else list_concat(w[1:a], list_transform(range(0, len(w) - a), lambda i: w[a + i % p + 1])) end as w from p),
      s as (select k, len(w) as n, i, array_to_string(w[i:i + 4], ' ') as x from r, unnest(range(1, len(w) - 3)) as u(i)),
      pairs as (select k, i, q, i - row_number() over (partition by k, q order by i) as g from (
          select x.k, x.i, y.i - x.i as q from s x join s y on x.k = y.k and x.x = y.x and y.i > x.i and 4 * (y.i - x.i) <= x.n)),
      long as (select k, min(i) - 1 as start, count(*) + 4 + q as length, q from pairs group by k, q, g having count(*) + 4 + q >= greatest(6, 4 * q)),
      runs as (select k, start, length, min(q) as period from long group by 1, 2, 3),
      listed as (select k, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines from runs group by 1),
      best as (select *, row_number() over (partition by k order by length desc, start, period) as nth from runs),
      gone as (select distinct k, i from runs, unnest(range(start + period, start + length)) as u(i)),
      kept as (select k, string_agg(word, ' ' order by i) as words from (select k, i, w[i + 1] as word from r, unnest(range(0, len(w))) as u(i)) anti join gone using (k, i) group by 1)
    select doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
      sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(words, '')) as collapsed_sha256
    from r left join listed using (k) left join kept using (k) left join (from best where nth = 1) b using (k)"""

PREFIX_TRIE = f"""
    with t as (select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x, turn from conversations where conv_id is not null),
      m as (select c, len(x) as chars, turn, md5(len(r) || ':' || r || x) as code from t),
      own as (select c, chars, code, row_number() over (partition by c order by turn nulls first, code) as k from m),
      h as (select c, {_CRC32.format('c')} % 6 as h from (select distinct c from own)),
      s as (select h.c, k, chars, code from h join own on own.c = h.c - h.c % 100 and k <= h
        union all select own.c, k, chars, code from own join h using (c) where k > h),
      d as (select c, chars, code, row_number() over (partition by c order by k) as d from s),
      p as (select c, d, chars, string_agg(code, '') over (partition by c order by d) as p from d
        union all select c, 0, 0, '' from h),
      depths as (select c, max(d) as depth from p group by 1),
      ends as (select p, string_agg(c, ',' order by c) as ends from p join depths using (c) where d = depth group by 1),
      n as (select p, d, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(chars) as own from p group by 1, 2),
      kids as (select left(p, 32 * (d - 1)) as p, count(*) as n_children from n where d > 0 group by 1),
      below as (select left(p, 32 * i) as p, sum(own) as saved, count(*) filter (n_children is null) as n_leaves
        from (select p, d, own, n_children from n left join kids using (p)), unnest(range(0, d + 1)) as u(i) group by 1)
    select n.conv_id, n.d as depth, up.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves,
      cast(saved as bigint) as saved_tokens, sha256(coalesce(ends, '')) as ends_sha256
    from n left join n up on n.d > 0 and up.p = left(n.p, 32 * (n.d - 1)) left join kids on kids.p = n.p join below on below.p = n.p left join ends on ends.p = n.p"""
