"""The same results in SQL for DuckDB, over the same tables."""

from __future__ import annotations

PARTS = "parts as (select * replace (nullif(p_brand, 'Brand#2') as p_brand) from part)"
GROUPED = (
    f"{PARTS}, grouped as (select *, count(*) over (partition by p_name, p_brand) as copies, "
    "min(p_partkey) over (partition by p_name, p_brand) as golden from parts)"
)
OBJECTS = """objects as (
  select case when event_type in ('purchase', 'error') then 'ledger' else 'open' end
         || '/' || event_type || '/' || event_id as key,
         ts, cast(length(props) as bigint) as size,
         'Owner=user' || user_id || '&Classification=' ||
         case event_type when 'purchase' then 'Secret' when 'error' then 'Internal'
              when 'signup' then 'Other' else 'Public' end || '&Domain=' ||
         case event_type when 'purchase' then 'Finance' when 'signup' then 'HR' else 'Eng' end as tags
  from events)"""
BRAND = """brand as (select p_brand as "BrandName",
  row_number() over (order by min(p_partkey)) - 1 as "BrandID" from parts group by p_brand)"""
KIND = """kind as (select p_type as "TypeName",
  row_number() over (order by min(p_partkey)) - 1 as "TypeID" from parts group by p_type)"""
STAR = f"""with {PARTS}, {BRAND}, {KIND}
  select p_partkey, p_name, "BrandID", "TypeID" from parts
  join brand on p_brand is not distinct from "BrandName"
  join kind on p_type is not distinct from "TypeName" """



def _similar(names: str) -> str:
    """All similar pairs of ``names`` (n, ord). Pairs are first bounded by the characters they
    share. Then the longest common block is taken out, earliest in a, then in b, and the same
    goes on left and right of it."""
    return f"""with recursive names as ({names}),
chars as (select n, c, count(*) as times
          from (select n, unnest(string_split(n, '')) as c from names) group by n, c),
pairs as (select x.n as a, y.n as b, any_value(nx.ord) as ord_a, any_value(ny.ord) as ord_b
          from chars x join chars y on x.c = y.c join names nx on nx.n = x.n
          join names ny on ny.n = y.n where nx.ord < ny.ord group by x.n, y.n
          having 200 * sum(least(x.times, y.times)) >= 85 * (length(x.n) + length(y.n))),
work as (
  select a, b, a as sa, b as sb, 0 as m from pairs
  union all
  select a, b, unnest([sa[:t.i-1], sa[t.i+t.k:]]) as sa,
               unnest([sb[:t.j-1], sb[t.j+t.k:]]) as sb, unnest([t.k, 0]) as m
  from (select a, b, sa, sb, max({{'k': k, 'ni': -i, 'nj': -j, 'i': i, 'j': j}}) as t
        from (select a, b, sa, sb, i, j,
                     unnest(range(1, least(length(sa) - i, length(sb) - j) + 2)) as k
              from (select * from (
                    select a, b, sa, sb, i, unnest(range(1, length(sb) + 1)) as j
                    from (select a, b, sa, sb, unnest(range(1, length(sa) + 1)) as i
                          from work where sa <> '' and sb <> ''))
                    where substr(sa, i, 1) = substr(sb, j, 1)))
        where substr(sa, i, k) = substr(sb, j, k) group by a, b, sa, sb)),
scored as (select a, b, cast(sum(m) as bigint) as m, length(a) + length(b) as total
           from work group by a, b),
alike as (select a as name_a, b as name_b, ord_a, ord_b, m as matched,
                   cast(total as bigint) as total, cast(2 * m as double) / total as ratio,
                   round(cast(2 * m as double) / total, 3) as score
            from scored join pairs using (a, b) where 200 * m >= 85 * total and 2 * m < total)
"""


FUZZY = _similar("""select p_name as n, row_number() over (order by min(p_partkey)) - 1 as ord
                    from part where p_name is not null group by p_name""")
FUZZY_URLS = _similar("""select url as n, row_number() over (order by min(page_id)) - 1 as ord
                         from pages where url is not null group by url""")


def _integrity(facts: str, master: str, before: str = "") -> str:
    return f"""with {before} f as (select distinct * from ({facts}) t(id)),
      g as (select distinct * from ({master}) t(id)),
      c as (select
        (select count(*) from f where not exists (select 1 from g where g.id = f.id)) as orphan_ids,
        (select count(*) from f) as fact_ids, (select count(*) from g) as golden_ids,
        (select count(*) from g where not exists (select 1 from f where g.id = f.id)) as unused_ids)
      select case when orphan_ids = 0 then 'SUCCESS' else 'ALERT' end as status, * from c"""


PUBLISHED = f"""with {GROUPED} select p_partkey, p_name, p_brand as "BrandName", p_type as "TypeName"
  from grouped where p_partkey = golden"""
CUSTOMER = "select * from customer"
GOLDEN = "select golden from grouped"
REMAPPED = "coalesce(golden, l_partkey) as l_partkey"

RULES = """rules as (
    select *, kind || c_custkey as prefix, 'arn:aws:s3:::vault/' || case c_nationkey % 3
        when 0 then kind || c_custkey || '*' when 1 then kind || '?' || c_custkey
        else kind || c_custkey || '?*7' end as resource
    from (select *, (['open/click/', 'open/view/', 'open/signup/', 'ledger/purchase/', 'ledger/error/'])
              [c_nationkey % 5 + 1] as kind from customer))"""

DAMAGED = """damaged as (
    select *, case when json_valid(props) then props::json end as doc from (
        select event_id, case event_type when 'error' then left(props, length(props) - 1)
            when 'signup' then '{"k": "many"}' when 'view' then '[1, 2]'
            when 'click' then '{"k": null, "x": 1.5}' else props end as props from events))"""

ORACLE: dict[str, str] = {
    "csv_roundtrip": CUSTOMER,
    "json_roundtrip": CUSTOMER,
    "parquet_roundtrip": CUSTOMER,
    "normalise_missing": "select * replace (nullif(event_type, 'error') as event_type, "
    "nullif(props, 'error') as props) from events",
    "key_projection": "select l_partkey, l_suppkey from lineitem",
    "json_fields": "select event_id, cast(props->>'$.k' as bigint) as k from events",
    "json_rejects": f"""with {DAMAGED} select event_id, case when rejected is null then try_cast(doc->>'$.k' as bigint) end as k,
        rejected from (select event_id, doc, case when not json_valid(props) then 'malformed'
          when json_type(doc) <> 'OBJECT' then 'not an object' when json_type(doc, '$.k') = 'VARCHAR' then 'field k'
          end as rejected from damaged)""",
    "json_shapes": f"""with {DAMAGED} select case when not json_valid(props) then null
        when json_type(doc) = 'ARRAY' then 'ARRAY<BIGINT>' when json_type(doc, '$.k') = 'VARCHAR' then 'OBJECT<k: STRING>'
        when json_type(doc, '$.k') = 'NULL' then 'OBJECT<k: VOID, x: DECIMAL(2,1)>' else 'OBJECT<k: BIGINT>' end as shape,
        count(*) as n_documents from damaged group by 1""",
    "stored_inventory": "select distinct 'event_type=' || event_type as prefix from events",
    "prefix_layout": "select event_type, strftime(ts, '%Y-%m-%d') as day, count(*) as n_objects, "
    "min(event_id) as first_id from events group by all",
    "prefix_read": "select event_id, event_type, value from events where event_type = 'error'",
    "exact_duplicates": f"with {GROUPED} select p_partkey, p_name, p_brand from grouped where copies > 1",
    "golden_records": f"with {GROUPED} select * exclude (copies, golden) from grouped where p_partkey = golden",
    "crosswalk": f"with {GROUPED} select p_partkey as retired_id, golden as golden_id from grouped "
    "where p_partkey <> golden",
    "dedup_counts": f"""with {GROUPED} select count(*) as original_rows,
      count(*) filter (p_partkey = golden) as golden_rows,
      count(*) filter (p_partkey <> golden) as retired_rows,
      count(*) filter (copies > 1) as duplicate_rows from grouped""",
    "distinct_ordered": "select p_name, row_number() over (order by min(p_partkey)) - 1 as ord "
    "from part where p_name is not null group by p_name",
    "fuzzy_pairs": FUZZY + "select name_a, name_b, matched, total, ratio, score from alike",
    "fuzzy_head": FUZZY + "select name_a, name_b, score from alike order by ord_a, ord_b limit 5",
    "fuzzy_topk": FUZZY + "select name_a, name_b, score from alike order by ratio desc, ord_a, ord_b limit 5",
    "fuzzy_urls_lossy": FUZZY_URLS + "select count(*) as n_exact, true as recalled from alike",
    "fuzzy_urls": FUZZY_URLS + "select name_a, name_b, matched, total, score from alike",
    "two_role_keys": "select c_nationkey as id from customer union select s_nationkey from supplier",
    "two_role_keys_one_table": "select l_partkey as id from lineitem union select l_suppkey from lineitem",
    "orphans": f"with {GROUPED} select distinct l_partkey as id from lineitem "
    "where not exists (select 1 from grouped where golden = l_partkey)",
    "orphans_filtered": f"with {GROUPED} select distinct l_partkey as id from lineitem "
    "where not exists (select 1 from grouped where golden = l_partkey)",
    "unused_filtered": "select c_custkey as id from customer "
    "where not exists (select 1 from events where user_id = c_custkey)",
    "fk_filtered": f"with {GROUPED} select l_partkey as id, count(*) as n_rows from lineitem "
    "where l_partkey is not null and not exists (select 1 from grouped where golden = l_partkey) "
    "group by all",
    "unused_master": "select c_custkey as id from customer "
    "where not exists (select 1 from events where user_id = c_custkey)",
    "integrity_report": _integrity(
        "select c_nationkey from customer union select s_nationkey from supplier",
        "select min(n_nationkey) from nation group by n_regionkey",
    ),
    "integrity_before_remap": _integrity("select l_partkey from lineitem", GOLDEN, GROUPED + ","),
    "integrity_after_remap": _integrity(
        "select coalesce(golden, l_partkey) from lineitem left join grouped on l_partkey = p_partkey",
        GOLDEN,
        GROUPED + ",",
    ),
    "remap_keys": f"with {GROUPED} select lineitem.* replace ({REMAPPED}) "
    "from lineitem left join grouped on l_partkey = p_partkey",
    "remap_two_roles": f"""with {GROUPED}, walk as (select p_partkey as id, golden from grouped)
      select lineitem.* replace (coalesce(a.golden, l_partkey) as l_partkey,
                                 coalesce(b.golden, l_suppkey) as l_suppkey)
      from lineitem left join walk a on l_partkey = a.id left join walk b on l_suppkey = b.id""",
    "remap_literal": "select * replace (case p_partkey when 11 then 3 when 19 then 3 when 42 then 40 "
    "else p_partkey end as p_partkey) from part",
    "dim_borough": f'with {PARTS}, {BRAND} select "BrandID", "BrandName" from brand',
    "dim_service": f'with {PARTS}, {KIND} select "TypeID", "TypeName" from kind',
    "star_dim": STAR,
    "star_head": STAR + " order by p_partkey limit 5",
    "star_publish": PUBLISHED,
    "star_publish_tables": PUBLISHED,
    "pk_violations": "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all "
    "having count(*) > 1 or l_orderkey is null or l_linenumber is null",
    "fk_violations": f"with {GROUPED} select l_partkey as id, count(*) as n_rows from lineitem "
    "where l_partkey is not null and not exists (select 1 from grouped where golden = l_partkey) "
    "group by all",
    "pk_over_batches": "select l_partkey, l_suppkey, count(*) as n_rows from lineitem group by all "
    "having count(*) > 1 or l_partkey is null or l_suppkey is null",
    "fk_over_batches": f"with {GROUPED} select l_partkey as id, count(*) as n_rows from lineitem "
    "where l_partkey is not null and not exists (select 1 from grouped where golden = l_partkey) "
    "group by all",
    "integrity_stored": "select 'before' as remap, * from ("
    + _integrity("select l_partkey from lineitem", GOLDEN, GROUPED + ",")
    + ") union all select 'after' as remap, * from ("
    + _integrity(
        "select coalesce(golden, l_partkey) from lineitem left join grouped on l_partkey = p_partkey",
        GOLDEN,
        GROUPED + ",",
    )
    + ")",
    "entity_profile": """
      select 'part' as table_name, 'master' as entity_class, count(*) as n_rows,
             format('{:,}', count(*)) as n_rows_text from part
      union all select 'nation', 'reference', count(*), format('{:,}', count(*)) from nation
      union all select 'lineitem', 'transactional', count(*), format('{:,}', count(*)) from lineitem""",
    "schema_profile": "with " + ", ".join(
        f"{t}_columns as (select '{t}' as table_name, row_number() over () - 1 as position, "
        f"column_name, column_type, (select count(*) from {t}) as n_rows from (describe {t}))"
        for t in ("part", "lineitem", "events")
    ) + """ select table_name, position, column_name, case column_type when 'BIGINT' then 'bigint'
      when 'INTEGER' then 'int' when 'DOUBLE' then 'double' when 'VARCHAR' then 'string'
      when 'TIMESTAMP' then 'timestamp_ntz' end as column_type, n_rows
      from (select * from part_columns union all select * from lineitem_columns
            union all select * from events_columns)""",
    "reference_values": """
      select 'l_returnflag' as column_name, l_returnflag as value, count(*) as n_rows
      from lineitem group by l_returnflag
      union all select 'l_linestatus', l_linestatus, count(*) from lineitem group by l_linestatus
      union all select 'l_linenumber', cast(l_linenumber as varchar), count(*)
      from lineitem group by l_linenumber""",
    "object_inventory": f"with {OBJECTS} select * from objects",
    "retention_expired": f"""with {OBJECTS} select key,
        case when starts_with(key, 'ledger/') then 'yearly' else 'short-lived' end as rule_id
      from objects where (starts_with(key, 'open/click/') and ts < timestamp '2024-02-10' - interval 12 day)
         or (starts_with(key, 'ledger/') and ts < timestamp '2024-02-10' - interval 365 day)""",
    "grant_check": f"""with {OBJECTS} select key, starts_with(key, 'ledger/purchase/')
        or starts_with(key, 'ledger/error/1') or starts_with(key, 'open/view/') as allowed from objects""",
    "prefix_rules": f"""with {OBJECTS}, {RULES} select key, max_by(prefix, length(prefix)) as prefix,
        max_by(c_mktsegment, length(prefix)) as purpose
      from objects left join rules on starts_with(key, prefix) group by key""",
    "retention_rules": f"""with {OBJECTS}, {RULES} select key, min({{'d': c_custkey % 40 + 1, 'r': c_name}}).r as rule_id
      from objects join rules on starts_with(key, prefix)
        and ts < timestamp '2024-02-10' - to_days(cast(c_custkey % 40 + 1 as int))
      where c_nationkey > 2 group by key, ts""",
    "grant_rules": f"""with {OBJECTS}, {RULES} select key, count(c_custkey) > 0 as allowed
      from objects left join rules on 'arn:aws:s3:::vault/' || key glob resource
        and (c_nationkey < 12 or c_nationkey >= 18) and c_nationkey < 20 group by key""",
    "tags_to_map": f"""with {OBJECTS}, tagged as (select key, map_from_entries(list_transform(
        string_split(tags, '&'), lambda x: (split_part(x, '=', 1), split_part(x, '=', 2)))) as m
      from objects)
      select key, m['Owner'] as owner, m['Classification'] as classification,
             m['Domain'] as domain, cast(cardinality(m) as bigint) as n_tags from tagged""",
    "tags_exploded": f"""with {OBJECTS}, written as (
        select key, unnest(string_split(tags, '&')) as pair from objects)
      select key, split_part(pair, '=', 1) as tag, split_part(pair, '=', 2) as value from written""",
    "tag_violations": f"""with {OBJECTS}, written as (
        select key, unnest(string_split(tags, '&')) as pair from objects),
      tags as (select key, split_part(pair, '=', 1) as tag, split_part(pair, '=', 2) as value from written),
      rules(tag) as (values ('Classification'), ('Domain'), ('Owner'))
      select key, tag, value, 'not allowed' as problem from tags
      where (tag = 'Classification' and value not in ('Public', 'Internal', 'Secret'))
         or (tag = 'Domain' and value not in ('Finance', 'HR', 'Eng'))
      union all
      select key, tag, null, 'repeated' from tags group by key, tag having count(*) > 1
      union all
      select o.key, r.tag, null, 'missing' from objects o, rules r
      where not exists (select 1 from tags t where t.key = o.key and t.tag = r.tag and t.value <> '')""",
    "manifest_prefixes": f"""with {OBJECTS},
      manifest(prefix, purpose) as (values ('ledger/', 'money and failures'),
        ('ledger/purchase/', 'sales ledger'), ('open/', 'free to look at'), ('attic/', 'nothing yet')),
      owned as (select key, max_by(prefix, length(prefix)) as prefix
                from objects join manifest on starts_with(key, prefix) group by key)
      select prefix, purpose, (select count(*) from owned o where o.prefix = m.prefix) as n_objects
      from manifest m""",
    "prefix_purpose": f"""with {OBJECTS} select key,
      case when starts_with(key, 'ledger/purchase/') then 'ledger/purchase/'
           when starts_with(key, 'ledger/') then 'ledger/' when starts_with(key, 'open/') then 'open/'
           end as prefix,
      case when starts_with(key, 'ledger/purchase/') then 'sales ledger'
           when starts_with(key, 'ledger/') then 'money and failures'
           when starts_with(key, 'open/') then 'free to look at' end as purpose
      from objects""",
    "prefix_usage": f"""with {OBJECTS} select split_part(key, '/', 1) || '/' || split_part(key, '/', 2)
      as prefix, count(*) as n_objects, cast(sum(size) as bigint) as n_bytes from objects group by 1""",
}
