"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import (byte_convnet, content_sort, doubling, licences, ngram_join, packing, page_text, positional_index,
                         prefix_trie, repeats, string_kernel, url_reputation, whitening)
from daybook.llm.tables import table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_content_sort(spark, folder):
    return content_sort.copies(table(spark, folder, "documents"))


def op7_positional_index(spark, folder):
    return positional_index.digest(positional_index.matches(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")))


def op10_min_bin_slack(spark, folder):
    return packing.pieces(table(spark, folder, "documents"), vocabulary())


def op4_byte_convnet(spark, folder):
    docs = table(spark, folder, "documents")
    return byte_convnet.scores(docs, byte_convnet.fit(docs, table(spark, folder, "labels")))


def op9_string_kernel(spark, folder):
    docs = table(spark, folder, "documents")
    return string_kernel.predict(docs, string_kernel.fit(docs))


def op5_signature_tree(spark, folder):
    return ngram_join.join(table(spark, folder, "documents"))


def op1_licences(spark, folder):
    """Documents as files: the source is the top directory, the leading digits of the id those below."""
    name = F.col("doc_id").cast("string")
    digits = F.split(F.substring(name, F.lit(1), F.greatest(F.length(name) - 2, F.lit(0))), "")
    path = F.concat(F.lit("/"), "source", F.concat_ws("", F.transform(
        F.filter(digits, lambda d: d != ""), lambda d: F.concat(F.lit("/"), d))), F.lit("/"), name)
    docs = table(spark, folder, "documents")
    return licences.scan(docs.select("doc_id", F.coalesce(path, F.lit("")).alias("path"), "text"))


def op2_suffix_array(spark, folder):
    return repeats.remove(table(spark, folder, "documents"))


def _shown():
    """The document that a page shows: the number its path ends with."""
    _, path = url_reputation.split(F.col("url"))
    return F.regexp_extract(path, r"/([0-9]+)(?:\.[a-z]+|/)?$", 1).try_cast("long")


def op3_url_reputation(spark, folder):
    pages = table(spark, folder, "pages")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("shown"), F.col("quality").alias("good"))
    outcomes = pages.select("page_id", _shown().alias("shown")).join(labels, "shown").select("page_id", "good")
    return url_reputation.verdicts(pages, outcomes)


def op8_scored_regions(spark, folder):
    pages = table(spark, folder, "pages")
    known = (pages.select("page_id", _shown().alias("doc_id"))
             .join(table(spark, folder, "documents").select("doc_id", "text"), "doc_id").select("page_id", "text"))
    return page_text.texts(pages, page_text.fit(pages, known))


def op11_prefix_trie(spark, folder):
    return prefix_trie.nodes(prefix_trie.rebuilt(table(spark, folder, "conversations")))


def op12_doubling(spark, folder):
    return doubling.remove(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"), "n_spans")


def op13_block_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES = {
    "op1_licences": op1_licences,
    "op2_suffix_array": op2_suffix_array,
    "op3_url_reputation": op3_url_reputation,
    "op8_scored_regions": op8_scored_regions,
    "op5_signature_tree": op5_signature_tree,
    "op4_byte_convnet": op4_byte_convnet,
    "op9_string_kernel": op9_string_kernel,
    "op10_min_bin_slack": op10_min_bin_slack,
    "op7_positional_index": op7_positional_index,
    "op6_content_sort": op6_content_sort,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_doubling": op12_doubling,
    "op13_block_whitening": op13_block_whitening,
}

ORACLE = {
    "op1_licences": licences.oracle(),
    "op3_url_reputation": r"""
        with a as (select page_id, case when strpos(url, '://') > 0
                          then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
        h as (select page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') as raw, coalesce(rest, '') as rest from a),
        u as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                     regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from h),
        o as (select u.page_id, host, min(quality) as good from u join labels l
              on l.doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]+)(?:\.[a-z]+|/)?$', 1), '') as bigint)
              where quality is not null group by u.page_id, host),
        parts as (select distinct host, coalesce(regexp_extract(host, '[^.]*\.[^.]*$'), '') as two,
                         regexp_extract(host, '[^.]*$') as suffix from u),
        names as (select host, suffix, case when two = '' then host else two end as domain from parts),
        hs as (select host, domain, suffix, count(*)::double as n, sum(good)::double as g
               from o join names using (host) group by all),
        ds as (select suffix, domain, sum(n) as n, sum(g) as g from hs group by all),
        ss as (select suffix, sum(n) as n, sum(g) as g from ds group by all),
        units as (select 'host' as lvl, n, g from hs union all select 'domain', n, g from ds
                  union all select 'suffix', n, g from ss),
        sums as (select lvl, count(*)::double as k, sum(n) as t, sum(g) as g, sum(n * n) as nn, sum(g * g / n) as gg
                 from units group by lvl),
        anova as (select lvl, k, t, (gg - g * g / t) / nullif(k - 1, 0) as b, (g - gg) / nullif(t - k, 0) as w,
                         (t - nn / t) / nullif(k - 1, 0) as n0 from sums),
        strengths as (select lvl, case when k > 1 and t > k and b + (n0 - 1) * w > 0 then
                          case when (b - w) / (b + (n0 - 1) * w) <= 0.001 then 999.0::double
                               else greatest(1 / ((b - w) / (b + (n0 - 1) * w)) - 1, 1.0::double) end
                      else 10.0::double end as s from anova),
        k as (select coalesce(max(s) filter (lvl = 'host'), 10.0) as kh, coalesce(max(s) filter (lvl = 'domain'), 10.0) as kd,
                     coalesce(max(s) filter (lvl = 'suffix'), 10.0) as ks from strengths),
        total as (select (coalesce(sum(g), 0) + 1) / (coalesce(sum(n), 0) + 2) as p from ss),
        level as (select names.host, coalesce(hs.n, 0) as n, coalesce(hs.g, 0) as g, kh,
                         (coalesce(ds.g, 0) + kd * ((coalesce(ss.g, 0) + ks * p) / (coalesce(ss.n, 0) + ks)))
                         / (coalesce(ds.n, 0) + kd) as p
                  from names left join hs on hs.host = names.host
                  left join ds on ds.domain = names.domain and ds.suffix = names.suffix
                  left join ss on ss.suffix = names.suffix, k, total),
        rated as (select host, (g + kh * p) / (n + kh) as rate, n + kh as size from level),
        rules(verdict, rhost, rpath) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
            ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
        ruled as (select page_id, arg_max(rhost || rpath, length(rhost || rpath)) as rule,
                         arg_max(verdict, length(rhost || rpath)) as verdict
                  from u join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
                  group by page_id)
        select u.page_id, u.host, path, rule, coalesce(ruled.verdict,
               case when rate + 1.64 * sqrt(rate * (1 - rate) / (size + 1)) < 0.7 then 'block' else 'allow' end) as verdict,
               round(rate, 6) as good_rate
        from u left join ruled using (page_id) join rated on rated.host = u.host""",
    "op7_positional_index": r"""
        with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        b as (select item_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
        bw as (select distinct item_id, least(10, len(w)) as n,
                      array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as win
               from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
                     from b where len(w) > 0)),
        sizes as (select distinct n from bw),
        dw as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
               from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
                     from d, sizes where len(w) >= n)),
        m as (select doc_id, i, dw.n, item_id from dw join bw on dw.n = bw.n and dw.win = bw.win),
        hit as (select doc_id, count(distinct p) as n_hit
                from (select doc_id, unnest(range(i, i + n)) as p from m) group by doc_id),
        items as (select doc_id, count(distinct item_id) as n_items,
                         string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
                  from m group by doc_id)
        select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join hit using (doc_id) left join items using (doc_id)""",
    "op6_content_sort": r"""
        with n as (select doc_id, length(coalesce(text, '')) as points,
                          regexp_replace(coalesce(text, ''), '[ \t-\r]+', '', 'g') as content
                   from documents)
        select doc_id, first_value(doc_id) over w as keep_id,
               count(*) over (partition by content) as group_size,
               doc_id = first_value(doc_id) over w as kept, sha256(content) as text_sha256
        from n window w as (partition by content order by points desc, doc_id)""",
    "op11_prefix_trie": r"""
        with t as (select conv_id as c, coalesce(text, '') as x,
                          substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) as g,
                          turn from conversations where conv_id is not null),
        k as (select c, x, g, row_number() over (partition by c order by turn nulls first, g) as k from t),
        ids as (select distinct c from k),
        -- crc32 of the decimal id: its bytes, each followed by eight shifts (-1)
        m as (select c, xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
                     string_split(c::varchar, ''), lambda s: [ascii(s)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
                 lambda a, e: case when e >= 0 then xor(a, e) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295) % 4 as h
              from ids),
        b as (select m.c, 0 as own, k.k, k.x, k.g from m join k on k.c = m.c - m.c % 20 and k.k <= m.h
              union all select m.c, 1, k.k, k.x, k.g from m join k on k.c = m.c and k.k > m.h),
        r as (select c, x, row_number() over w as d, string_agg(g, '') over (w rows unbounded preceding) as pid
              from b window w as (partition by c order by own, k)),
        p as (select c, 0 as d, '' as pid, null as parent, 0 as w from ids
              union all select c, d, pid, coalesce(lag(pid) over (partition by c order by d), ''),
                               len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) from r),
        node as (select pid, any_value(d) as d, any_value(parent) as parent, min(c) as conv_id, count(*) as n, any_value(w) as w
                 from p group by pid),
        ends as (select pid, sha256(string_agg(c::varchar, ',' order by c)) as ended
                 from (select c, pid from p qualify row_number() over (partition by c order by d desc) = 1) group by pid),
        kids as (select parent as pid, count(*) as kids from node where parent is not null group by parent),
        sub as (select a.pid, sum((n - 1) * y.w)::bigint as saved, count(*) filter (kids is null) as leaves
                from node y left join kids on kids.pid = y.pid join p a on a.c = y.conv_id and a.d <= y.d group by a.pid)
        select node.conv_id, node.d::bigint as depth, above.conv_id as parent_conv_id, node.n as n_convs,
               coalesce(kids, 0) as n_children, leaves as n_leaves, saved as saved_tokens, coalesce(ended, sha256('')) as ends_sha256
        from node join sub using (pid) left join node above on above.pid = node.parent
        left join kids on kids.pid = node.pid left join ends on ends.pid = node.pid""",
}
