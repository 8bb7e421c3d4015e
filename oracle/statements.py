"""DuckDB SQL for the queries, as a direct statement of each definition.

The order path joins baskets in the plain order of its stages: pairs are expanded over
all items and restricted afterwards, totals are joined back, adjustments are separate
joins. None of the engine's rewrites is used here.
"""

from __future__ import annotations

START, END = "1995-08-01", "2001-07-31"

ROLES = {
    "order_lines": """
        select p.p_type as cid3, cast(o.o_custkey as varchar) as user_id,
               cast(o.o_orderkey as varchar) as parent_sale_ord_id,
               concat(cast(o.o_orderkey as varchar), '-', cast(l.l_linenumber as varchar)) as sale_ord_id,
               cast(l.l_partkey as varchar) as item_sku_id, o.o_orderdate as sale_ord_tm,
               cast(o.o_orderdate as date) as sale_ord_dt, l.l_quantity as sale_qtty,
               cast(l.l_extendedprice as decimal(18,2)) as before_amt,
               cast(l.l_extendedprice as decimal(18,2)) * (1 - cast(l.l_discount as decimal(4,2))) as after_amt,
               case when o.o_orderstatus in ('F', 'O') then 1 else 0 end as valid
        from orders o join lineitem l on l.l_orderkey = o.o_orderkey join part p on p.p_partkey = l.l_partkey""",
    "skus": """
        select cast(p_partkey as varchar) as item_sku_id, p_name as sku_name, p_type as cid3, p_brand,
               case when p_size <= 30 then 'self' when p_size <= 45 then 'pop' else 'other' end as sku_type
        from part""",
    "attrs": """
        select cast(p_partkey as varchar) as sku_id, 1 as web_id, '品牌' as attr_name, p_brand as attr_value from part
        union all select cast(p_partkey as varchar), 1, 'colour', split_part(p_name, ' ', 1) from part
        union all select cast(p_partkey as varchar), 1, 'noun', split_part(p_name, ' ', 2) from part
        union all select cast(p_partkey as varchar), 1, 'size', cast(p_size as varchar) from part where p_partkey % 10 <> 0
        union all select cast(p_partkey as varchar), 2, '品牌', 'competitor' from part where p_partkey % 5 = 0""",
    "more_attrs": """
        select * from attrs
        union all select cast(p_partkey as varchar), 1, 'price', cast(cast(p_retailprice as decimal(18,2)) as varchar) from part
        union all select cast(p_partkey as varchar), 1, '价格', cast(cast(p_retailprice as decimal(18,2)) as varchar) from part where p_type in ('ECONOMY', 'LARGE')
        union all select cast(p_partkey as varchar), 1, 'volume', cast(p_size as varchar) from part
        union all select cast(p_partkey as varchar), 1, '总容量', cast(p_size as varchar) from part where p_type = 'PROMO'
        union all select cast(p_partkey as varchar), 1, '总重量', cast(p_size as varchar) from part where p_type = 'SMALL'
        union all select cast(p_partkey as varchar), 1, 'unit', cast(p_partkey % 7 as varchar) from part where p_partkey % 2 = 0""",
    "brands": """
        select concat('b', split_part(p_brand, '#', 2)) as brand_id, p_brand as brand_name from part where p_brand <> 'Brand#7'
        union select concat('z', split_part(p_brand, '#', 2)), p_brand from part where p_brand = 'Brand#3'""",
    "tree": """
        select distinct '1' as c1, case when p_type in ('ECONOMY', 'PROMO', 'STANDARD') then '11' else '12' end as c2,
               p_type as c3, lower(p_type) as name from part""",
    "fourth": """
        select cast(p_partkey as varchar) as sku_id, p_type as cid3, split_part(p_name, ' ', 2) as attr_value from part""",
    "clicks": """
        select regexp_extract(props, '([0-9]+)', 1) as item_sku_id, cast(user_id as varchar) as user_log_acct,
               cast(ts as date) as request_dt, concat(cast(cast(ts as date) as varchar), event_type) as session_id
        from events
        where cast(ts as date) >= date '2024-01-20' and cast(ts as date) < date '2024-01-31'
          and event_type in ('view', 'click', 'purchase', 'signup')""",
    "brand_of": """
        select a.item_sku_id, a.item_name, b.item_id
        from (select sku_id as item_sku_id, min(attr_value) as item_name from attrs
              where web_id < 2 and attr_name = '品牌' group by 1) a
        left join (select brand_name, min(brand_id) as item_id from brands group by 1) b on b.brand_name = a.item_name""",
    "control": """
        select case when min(o_orderkey) % 3 = 0 then '0' else '1' end as status,
               cast(cast(date_trunc('quarter', o_orderdate) as date) as varchar) as dt, o_orderpriority as cid3
        from orders group by 2, 3""",
}


def scope_sql(self_pop: str, item_type: str) -> str:
    return f"""
        select concat_ws('_', c1, c2, c3, '{self_pop}', 'lvl3', name, '{item_type}') as scope_id, c1, c2, c3,
               '{self_pop}' as self_pop, 'lvl3' as scope_type, name as scope_desc, '{item_type}' as item_type from tree"""


SUB_SCOPES = """
        select distinct concat_ws('_', t.c1, t.c2, t.c3, 'self_lvl4', a.attr_value, 'sku') as scope_id, t.c3,
               'lvl4' as scope_type, a.attr_value as scope_desc
        from tree t join skus s on s.cid3 = t.c3 join attrs a on a.sku_id = s.item_sku_id and a.attr_name = 'noun'"""


def order_steps(item_type: str = "sku", by_day: bool = False, entropy: bool = True) -> dict[str, str]:
    """The order path as named steps."""
    key = "sale_ord_dt" if by_day else "sale_ord_tm, parent_sale_ord_id"
    mapped = {
        "sku": "select k.*, k.item_sku_id as item_id from kept k",
        "brand": "select k.*, m.item_id from kept k left join brand_of m on m.item_sku_id = k.item_sku_id where m.item_id is not null",
    }[item_type]
    cr = "coalesce(c.cr, 0)" if entropy else "0"
    return {
        "scopes": scope_sql("self", item_type),
        "facts": f"""
            select s.scope_id, o.* from order_lines o join skus k on k.item_sku_id = o.item_sku_id and k.sku_type = 'self'
            join scopes s on s.c3 = o.cid3
            where o.valid = 1 and o.sale_ord_dt between date '{START}' and date '{END}'""",
        "customers": "select scope_id, user_id, count(distinct parent_sale_ord_id) as ord_qtty from facts group by all",
        "tail": """
            select * from (
              select scope_id, item_sku_id, qty, sum(qty) over (partition by scope_id order by qty desc, item_sku_id
                       rows between unbounded preceding and current row) / sum(qty) over (partition by scope_id) as cum_ratio
              from (select scope_id, item_sku_id, sum(sale_qtty) as qty from facts group by all))
            where cum_ratio <= 0.95""",
        "kept": "select f.* from facts f join tail t on t.scope_id = f.scope_id and t.item_sku_id = f.item_sku_id",
        "mapped": mapped,
        "big_items": """
            select scope_id, item_id, sum(before_amt) as amount from mapped group by all having sum(before_amt) > 500000""",
        "weeks": f"""
            select scope_id, item_id, count(distinct ceil((date_diff('day', date '{START}', sale_ord_dt) + 1) / 7.0)) as weeknum
            from (select scope_id, item_id, sale_ord_dt, sum(before_amt) as amount from mapped group by all)
            where amount > 0 group by all having weeknum >= 10""",
        "bought": """
            select m.* from mapped m join customers c on c.scope_id = m.scope_id and c.user_id = m.user_id
            where c.ord_qtty between 2 and 24 and m.user_id <> '-1' and m.sale_qtty > 0 and m.before_amt > 0
              and m.after_amt >= 0.95 * m.before_amt""",
        "numbered": f"""
            select *, dense_rank() over (partition by scope_id, user_id order by {key}) as seq from bought""",
        "basket": """
            select scope_id, user_id, seq, item_id, sum(sale_qtty) as qty, cast(sum(before_amt) as double) as amt
            from numbered group by all""",
        "totals": """
            select scope_id, user_id, seq, cast(sum(before_amt) as double) as total, count(distinct item_id) as n
            from numbered group by all""",
        "lines": "select b.*, t.total, t.n from basket b join totals t using (scope_id, user_id, seq)",
        "flows": """
            select a.scope_id, a.item_id as dst, b.item_id as src, a.amt as dst_amt, b.amt as src_amt,
                   (a.amt / a.total) * (b.amt / b.total) * (a.total + b.total) as ss
            from lines a join lines b on b.scope_id = a.scope_id and b.user_id = a.user_id and b.seq + 1 = a.seq""",
        "raw": """
            select scope_id, src, dst, sum(dst_amt) as dst_amt, sum(src_amt) as src_amt, sum(ss) as ss from flows group by all""",
        "items": """
            select g.scope_id, g.item_id from big_items g join weeks w using (scope_id, item_id)
            where exists (select 1 from raw r where r.scope_id = g.scope_id and r.dst = g.item_id and r.ss > 0)""",
        "nb": "select scope_id, count(*) as nb from items group by all",
        "spend": """
            select l.scope_id, l.user_id, l.item_id, sum(l.amt) as s
            from lines l join items i using (scope_id, item_id) group by all""",
        "theil": """
            select scope_id, user_id, t, (1 - 2 * t) / (2 * t * t - 2 * t + 1) as comp from (
              select s.scope_id, s.user_id, sum((s.s / m.m) * ln(s.s / m.m)) / (any_value(n.nb) * ln(any_value(n.nb))) as t
              from spend s join nb n using (scope_id)
              join (select x.scope_id, x.user_id, sum(x.s) / any_value(y.nb) as m from spend x join nb y using (scope_id) group by all) m
                on m.scope_id = s.scope_id and m.user_id = s.user_id
              group by all)""",
        "inside": """
            select a.scope_id, a.user_id, a.item_id as dst, b.item_id as src, sum(a.amt) as dst_amt, sum(b.amt) as src_amt,
                   sum((a.amt / a.total) * (b.amt / b.total) * (a.total + b.total)) as ss
            from lines a join lines b on b.scope_id = a.scope_id and b.user_id = a.user_id and b.seq = a.seq and b.item_id <> a.item_id
            join items i on i.scope_id = a.scope_id and i.item_id = a.item_id
            join items j on j.scope_id = b.scope_id and j.item_id = b.item_id
            group by all""",
        "comp": """
            select w.scope_id, w.src, w.dst, sum(w.ss * t.comp) / sum(w.dst_amt + w.src_amt) as cr
            from inside w join theil t using (scope_id, user_id) group by all""",
        "adjusted_once": f"""
            select r.*, {cr} as cr, r.ss * (1 + {cr}) as ca
            from raw r left join comp c on c.scope_id = r.scope_id and c.src = r.src and c.dst = r.dst""",
        "n_orders": "select scope_id, count(distinct parent_sale_ord_id) as n from numbered group by all",
        "item_baskets": "select scope_id, item_id, count(*) as n from basket group by all",
        "together": """
            select a.scope_id, a.item_id as dst, b.item_id as src, count(*) as ab
            from lines a join lines b on b.scope_id = a.scope_id and b.user_id = a.user_id and b.seq = a.seq and b.item_id <> a.item_id
            where a.n > 1 group by all""",
        "lifts": """
            select t.scope_id, t.src, t.dst, t.ab, s.n as src_n, d.n as dst_n, t.ab / d.n / s.n * o.n as lift
            from together t join item_baskets s on s.scope_id = t.scope_id and s.item_id = t.src
            join item_baskets d on d.scope_id = t.scope_id and d.item_id = t.dst join n_orders o on o.scope_id = t.scope_id""",
        "cis": "select *, least((1 - lift * lift) / (1 + lift * lift), 0) as ci from lifts",
        "adjusted": """
            select a.*, coalesce(c.ci, 0) as ci, c.ab, c.src_n, c.dst_n, a.ca * (1 + coalesce(c.ci, 0)) as ad
            from adjusted_once a left join cis c on c.scope_id = a.scope_id and c.src = a.src and c.dst = a.dst
            join items i on i.scope_id = a.scope_id and i.item_id = a.dst
            join items j on j.scope_id = a.scope_id and j.item_id = a.src""",
        "sums": "select scope_id, src, sum(ad) as total from adjusted group by all",
        "switching": """
            select a.scope_id, a.src as src_item_id, a.dst as dst_item_id, a.ad / s.total as switching_prob, 'order' as model
            from adjusted a join sums s on s.scope_id = a.scope_id and s.src = a.src""",
    }


def log_steps(item_type: str = "sku") -> dict[str, str]:
    mapped = {
        "sku": "select c.*, c.item_sku_id as item_id from clicks c join skus k on k.item_sku_id = c.item_sku_id where k.sku_type = 'self'",
        "brand": """select c.*, m.item_id from clicks c join skus k on k.item_sku_id = c.item_sku_id and k.sku_type = 'self'
                    join brand_of m on m.item_sku_id = c.item_sku_id where m.item_id is not null""",
    }[item_type]
    return {
        "whole": f"""
            select concat_ws('_', string_agg(c1, '-' order by c3), string_agg(c2, '-' order by c3), string_agg(c3, '-' order by c3),
                             'self', 'lvl3', string_agg(name, '-' order by c3), '{item_type}') as scope_id from tree""",
        "seen": mapped,
        "met": """
            select a.item_id as src_item_id, b.item_id as dst_item_id, count(*) as page_views
            from seen a join seen b on b.user_log_acct = a.user_log_acct and b.session_id = a.session_id and b.request_dt = a.request_dt
            group by all""",
        "log_switching": """
            select w.scope_id, m.src_item_id, m.dst_item_id, m.page_views / t.total as switching_prob, 'log' as model
            from met m join (select src_item_id, sum(page_views) as total from met group by all) t using (src_item_id), whole w""",
    }


def attr_steps(source: str = "attrs") -> dict[str, str]:
    """Attributes per scope, and their split."""
    return {
        "scope3": scope_sql("self", "sku"),
        "sattr": f"""
            select s.scope_id, a.attr_name as attr_key, a.sku_id as item_id, nullif(trim(a.attr_value), '') as attr_val
            from {source} a join skus k on k.item_sku_id = a.sku_id and k.sku_type = 'self' join scope3 s on s.c3 = k.cid3
            where a.web_id < 2""",
        "kinds": """
            select scope_id, attr_key, count(attr_val) > 0 and count(attr_val) = count(try_cast(attr_val as double)) as numeric
            from sattr group by all""",
        "keys": "select distinct scope_id, attr_key from sattr",
        "twins": """
            select * from (values ('unit', '包装件数', 1), ('volume', '总容量', 1), ('volume', '总重量', 2), ('unit_volume', '单件容量', 1),
              ('unit_price', '单件价格', 1), ('per_price', '单位容量价格', 1), ('price', '价格', 1)) t(derived, twin, rank)""",
        "paired": """
            select d.scope_id, t.derived, t.twin, t.rank from keys d join twins t on t.derived = d.attr_key
            join keys k on k.scope_id = d.scope_id and k.attr_key = t.twin""",
        "kept_keys": """
            select k.scope_id, k.attr_key,
                   coalesce((select arg_max(p.twin, p.rank) from paired p where p.scope_id = k.scope_id and p.derived = k.attr_key), '') as shown_as
            from keys k
            where not exists (select 1 from paired p where p.scope_id = k.scope_id and p.twin = k.attr_key)
              and (k.attr_key not in (select derived from twins)
                   or exists (select 1 from paired p where p.scope_id = k.scope_id and p.derived = k.attr_key))""",
        "vals": """
            select a.scope_id, a.attr_key, a.item_id, max(a.attr_val) as text_val, max(try_cast(a.attr_val as double)) as num_val,
                   any_value(n.numeric) as numeric
            from sattr a join kinds n using (scope_id, attr_key) join kept_keys k using (scope_id, attr_key) group by 1, 2, 3""",
    }


PAIR_STEPS = {
    "pairs": """
        select scope_id, src_item_id, dst_item_id, switching_prob from switching where switching_prob > 0 and src_item_id <> dst_item_id""",
    "grid": """
        select p.*, k.attr_key, k.numeric, s.item_id is not null as s_has, d.item_id is not null as d_has,
               s.text_val as s_text, d.text_val as d_text, s.num_val as s_num, d.num_val as d_num
        from pairs p join (select distinct scope_id, attr_key, numeric from vals) k on k.scope_id = p.scope_id
        left join vals s on s.scope_id = p.scope_id and s.attr_key = k.attr_key and s.item_id = p.src_item_id
        left join vals d on d.scope_id = p.scope_id and d.attr_key = k.attr_key and d.item_id = p.dst_item_id""",
    "cat_raw": """
        select *, case when s_has then s_text else 'None' end as sv, case when d_has then d_text else 'None' end as dv
        from grid where not numeric""",
    "cat_sim": """
        select scope_id, src_item_id, dst_item_id, attr_key,
               case when sv is null or dv is null then avg(case when sv = dv then 1.0 else 0.0 end) over (partition by scope_id, attr_key)
                    when sv = dv then 1.0 else 0.0 end as similarity
        from cat_raw""",
    "num_raw": """
        select *, case when s_num > -1 and d_num > -1 then abs(log2(s_num + 1) - log2(d_num + 1)) end as d from grid where numeric""",
    "num_scaled": """
        select *, case when d is null then null when m = 0 then 1.0 else 1 - d / m end as sim
        from (select *, max(d) over (partition by scope_id, attr_key) as m from num_raw)""",
    "num_sim": """
        select scope_id, src_item_id, dst_item_id, attr_key, coalesce(sim, avg(sim) over (partition by scope_id, attr_key)) as similarity
        from num_scaled""",
    "net": f"""
        select item_sku_id as item_id, cast(sum(after_amt) as double) as sales from order_lines
        where valid = 1 and sale_ord_dt between date '{START}' and date '{END}' group by 1""",
    "sales": """
        select p.*, coalesce(s.sales, avg(s.sales) over (partition by p.scope_id)) as from_sales,
               coalesce(d.sales, avg(d.sales) over (partition by p.scope_id)) as to_sales
        from pairs p left join net s on s.item_id = p.src_item_id left join net d on d.item_id = p.dst_item_id""",
}

PAIR = "scope_id, src_item_id, dst_item_id"
FOREST = "Random Forest Regression"

GHOST = "0_0_GHOST_self_lvl3_None_sku"

def mixed_steps() -> dict[str, str]:
    """The order path with parameters by scope, over sku and brand scopes."""
    steps = order_steps()
    late = "c3 in ('ECONOMY', 'LARGE', 'PROMO')"
    changed = {
        "scopes": f"""
            select *, case when {late} then date '1995-08-01' else date '1995-01-01' end as start_day,
                   case when {late} then date '2001-07-31' else date '2000-12-31' end as end_day,
                   case when item_type = 'brand' then 0.9 when c3 = 'LARGE' then 1.0 else 0.95 end as share,
                   case when item_type = 'brand' then 300000 else 500000 end as least_sales, case when c3 = 'SMALL' then 6 else 10 end as least_weeks,
                   case when {late} then 1 else 2 end as least_orders, case when item_type = 'brand' then 30 else 24 end as most_orders,
                   case when c3 = 'MEDIUM' then null when c3 = 'PROMO' then 0.93 else 0.95 end as ratio,
                   c3 in ('STANDARD', 'PROMO') and item_type = 'brand' as by_day, c3 <> 'ECONOMY' as entropy
            from ({scope_sql('self', 'sku')} union all {scope_sql('self', 'brand')})""",
        "facts": """
            select s.scope_id, o.* from order_lines o join skus k on k.item_sku_id = o.item_sku_id and k.sku_type = 'self'
            join scopes s on s.c3 = o.cid3 and o.sale_ord_dt between s.start_day and s.end_day where o.valid = 1""",
        "tail": steps["tail"].replace("where cum_ratio <= 0.95", "join scopes using (scope_id) where share = 1 or cum_ratio <= share"),
        "mapped": """
            select k.*, case when s.item_type = 'sku' then k.item_sku_id else m.item_id end as item_id
            from kept k join scopes s using (scope_id) left join brand_of m on m.item_sku_id = k.item_sku_id
            where s.item_type = 'sku' or m.item_id is not null""",
        "big_items": """
            select scope_id, item_id from mapped join scopes using (scope_id) group by scope_id, item_id, least_sales having sum(before_amt) > least_sales""",
        "weeks": """
            select d.scope_id, item_id from (select scope_id, item_id, sale_ord_dt, sum(before_amt) as amount from mapped group by all) d
            join scopes s on s.scope_id = d.scope_id where amount > 0 group by d.scope_id, item_id, least_weeks
            having count(distinct ceil((date_diff('day', start_day, sale_ord_dt) + 1) / 7.0)) >= least_weeks""",
        "bought": """
            select m.*, s.by_day from mapped m join scopes s using (scope_id) join customers c on c.scope_id = m.scope_id and c.user_id = m.user_id
            where c.ord_qtty between least_orders and most_orders and m.user_id <> '-1' and m.sale_qtty > 0 and m.before_amt > 0
              and (ratio is null or m.after_amt >= cast(ratio as decimal(4,2)) * m.before_amt)""",
        "numbered": """
            select *, dense_rank() over (partition by scope_id, user_id order by case when by_day then cast(sale_ord_dt as timestamp) else sale_ord_tm end,
                                         case when by_day then '' else parent_sale_ord_id end) as seq from bought""",
        "adjusted_once": """
            select r.*, case when s.entropy then coalesce(c.cr, 0) else 0 end as cr, r.ss * (1 + case when s.entropy then coalesce(c.cr, 0) else 0 end) as ca
            from raw r join scopes s using (scope_id) left join comp c on c.scope_id = r.scope_id and c.src = r.src and c.dst = r.dst""",
    }
    assert changed["tail"] != steps["tail"]
    return steps | changed


FIT_STEPS = {
    "sims": "select scope_id, src_item_id, dst_item_id, attr_key, similarity from cat_sim union all select scope_id, src_item_id, dst_item_id, attr_key, similarity from num_sim",
    "cells_all": """
        select scope_id, src_item_id, dst_item_id, 0 as kind, attr_key as name, cast(round(similarity * 1000000) as bigint) as v from sims
        union all select scope_id, src_item_id, dst_item_id, 1, 'fromSales', cast(round(from_sales * 100) as bigint) from sales
        union all select scope_id, src_item_id, dst_item_id, 1, 'toSales', cast(round(to_sales * 100) as bigint) from sales""",
    "feature": """
        select scope_id, kind, name, row_number() over (partition by scope_id order by kind, name) as f, count(*) over (partition by scope_id) as m
        from (select scope_id, kind, name from cells_all group by all having count(v) > 0)""",
    "complete": """
        select *, row_number() over (order by scope_id, src_item_id, dst_item_id) as r from (
          select scope_id, src_item_id, dst_item_id from cells_all join feature using (scope_id, kind, name) group by all having count(v) = count(*))""",
    "labels_": """
        select r, scope_id, src_item_id, dst_item_id, cast(round(switching_prob * 1000000000) as bigint) as label
        from complete join pairs using (scope_id, src_item_id, dst_item_id)
        where scope_id in (select scope_id from complete group by scope_id having count(*) > 1)""",
    "whole": """
        select r, scope_id, f, cast(floor(cast(v - min(v) over g as double) / cast(max(v) over g - min(v) over g + 1 as double) * 1048576) as bigint) as z
        from cells_all join feature using (scope_id, kind, name) join labels_ using (scope_id, src_item_id, dst_item_id)
        window g as (partition by scope_id, f)""",
}


def forest_steps(trees: int = 50, depth: int = 6, seed: int = 7) -> dict[str, str]:
    """A forest level by level. Every pair is stated anew for each tree that draws it."""
    steps = {
        "cell_n": "select scope_id, f, z // 1024 as cell, count(*) as n from whole group by all",
        "cell_bin": """
            select scope_id, f, cell, ((sum(n) over (partition by scope_id, f order by cell) - n) * 32) // sum(n) over (partition by scope_id, f) as bin
            from cell_n""",
        "binned": "select w.r, w.f, cast(b.bin as int) as bin from whole w join cell_bin b on b.scope_id = w.scope_id and b.f = w.f and b.cell = w.z // 1024",
        "drawn": f"""
            select r, scope_id, label, g * 8 + k as tree, u from (
              select r, scope_id, label, g, k, cast('0x' || substr(h, cast(4 * k + 1 as bigint), 4) as int) as u from (
                select r, scope_id, label, g, md5(concat('{seed}|', src_item_id, '|', dst_item_id, '|', g)) as h
                from labels_, (select unnest(range({-(-trees // 8)})) as g)), (select unnest(range(8)) as k))
            where g * 8 + k < {trees}""",
        "at0": """
            select * from (select r, scope_id, tree, label, 1 as node,
              len(list_filter([24109, 48219, 60273, 64292, 65296, 65497, 65531], lambda x: x <= u)) as w from drawn) where w > 0"""}
    for d in range(depth):
        steps |= {
            f"pick{d}": f"""
                select scope_id, tree, node, f from (
                  select n.scope_id, n.tree, n.node, f.f, f.m,
                         row_number() over (partition by n.scope_id, n.tree, n.node order by md5(concat(n.tree, '|', n.node, '|', f.name))) as place
                  from (select distinct scope_id, tree, node from at{d}) n join feature f on f.scope_id = n.scope_id)
                where place <= ceil(m / 3)""",
            f"stat{d}": f"""
                select a.scope_id, a.tree, a.node, p.f, b.bin, sum(a.w) as n, sum(a.w * a.label) as s
                from at{d} a join pick{d} p on p.scope_id = a.scope_id and p.tree = a.tree and p.node = a.node
                join binned b on b.r = a.r and b.f = p.f group by all""",
            f"cum{d}": f"""
                select scope_id, tree, node, f, bin, cast(sum(n) over x as double) as nl, cast(sum(s) over x as double) as sl,
                       cast(sum(n) over y as double) as n, cast(sum(s) over y as double) as s
                from stat{d} window x as (partition by scope_id, tree, node, f order by bin), y as (partition by scope_id, tree, node, f)""",
            f"split{d}": f"""
                select scope_id, tree, node, f, bin, gain from (
                  select *, row_number() over (partition by scope_id, tree, node order by gain desc, f, bin) as place from (
                    select *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n as gain from cum{d} where nl < n)
                  where gain > s * s / n * 1e-9)
                where place = 1""",
            f"at{d + 1}": f"""
                select a.r, a.scope_id, a.tree, a.label, 2 * a.node + case when b.bin > s.bin then 1 else 0 end as node, a.w
                from at{d} a join split{d} s on s.scope_id = a.scope_id and s.tree = a.tree and s.node = a.node join binned b on b.r = a.r and b.f = s.f"""}
    every = " union all ".join(f"select * from split{d}" for d in range(depth))
    return steps | {
        "by_tree": f"select scope_id, tree, f, sum(gain) as gain from ({every}) group by all",
        "weight": """
            select scope_id, f, sum(gain / total) as weight
            from by_tree join (select scope_id, tree, sum(gain) as total from by_tree group by all) using (scope_id, tree) group by all""",
        "weights": """
            select f.scope_id, f.name, coalesce(w.weight, 0) as weight from feature f left join weight w using (scope_id, f)
            where f.scope_id in (select scope_id from labels_)"""}


def net_steps(sweeps: int = 100) -> dict[str, str]:
    """Coordinate descent, one coefficient a step."""
    return {
        "columns_": """
            select r, scope_id, f, z from whole
            union all select r, scope_id, 1000000, cast(floor(cast(label - min(label) over g as double) / cast(max(label) over g - min(label) over g + 1 as double) * 1048576) as bigint)
            from labels_ window g as (partition by scope_id)""",
        "single": "select scope_id, f, count(*) as n, sum(z) as s, sum(z * z) as q from columns_ group by all",
        "cross_": """
            select a.scope_id, a.f as i, b.f as j, sum(a.z * b.z) as s from columns_ a join columns_ b on a.r = b.r and a.f <= 1000000 group by all""",
        "corr": """
            select c.scope_id, i, j, case when a.n * a.q > a.s * a.s and b.n * b.q > b.s * b.s
              then cast(a.n * c.s - a.s * b.s as double) / sqrt(cast(a.n * a.q - a.s * a.s as double)) / sqrt(cast(b.n * b.q - b.s * b.s as double)) else 0 end as x
            from cross_ c join single a on a.scope_id = c.scope_id and a.f = c.i join single b on b.scope_id = c.scope_id and b.f = c.j""",
        "matrix": """
            select scope_id, list(x order by i) as rows_, cast(max(len(x)) - 1 as bigint) as m
            from (select scope_id, i, list(x order by j) as x from corr group by all) group by all""",
        "descent": f"""
            select scope_id, m, rows_, cast(0 as bigint) as step, list_transform(range(m), lambda k: cast(0 as double)) as beta from matrix
            union all
            select scope_id, m, rows_, step + 1, list_transform(range(m), lambda k: case when k <> step % m then beta[k + 1] when rest is null then 0
                     else sign(rest) * greatest(abs(rest) - 0.01 * 0.5, 0) / (1 + 0.01 * (1 - 0.5)) end)
            from (select *, case when rows_[step % m + 1][step % m + 1] <> 0 then rows_[step % m + 1][m + 1]
                      - list_sum(list_transform(range(m), lambda k: case when k = step % m then 0 else rows_[step % m + 1][k + 1] * beta[k + 1] end)) end as rest
                  from descent where step < {sweeps} * m)""",
        "weights": f"""
            select f.scope_id, f.name, abs(n.beta[f.f]) as weight from feature f join descent n on n.scope_id = f.scope_id and n.step = {sweeps} * n.m"""}


FINE_STEPS = {
    "fine_skus": "select *, cid3 || ':' || p_brand as fine from skus",
    "fine": "select distinct fine, concat_ws('_', '1', '11', fine, 'self', 'lvl3', lower(fine), 'sku') as scope_id from fine_skus",
    "months": """
        select cast(m as date) as month from generate_series(timestamp '1999-08-01', timestamp '2001-07-01', interval 1 month) g(m)""",
    "per_month": """
        select k.fine, cast(date_trunc('month', o.sale_ord_dt) as date) as month, count(*) as n
        from order_lines o join fine_skus k using (item_sku_id) where o.valid = 1 group by all""",
    "coverage": """
        select f.scope_id, m.month, coalesce(p.n, 0) as n_lines from fine f cross join months m
        left join per_month p on p.fine = f.fine and p.month = m.month""",
}

WINDOW_STEPS = {
    "window_facts": f"""
        select w.name as "window", s.scope_id, o.* from order_lines o join skus k on k.item_sku_id = o.item_sku_id and k.sku_type = 'self'
        join scopes s on s.c3 = o.cid3
        join (values ('whole', date '{START}', date '{END}'), ('moved', date '1996-03-15', date '2001-05-20')) w(name, first, last)
          on o.sale_ord_dt between w.first and w.last
        where o.valid = 1""",
}

SOLD_RECENTLY = f"select distinct item_sku_id from order_lines where valid = 1 and sale_ord_dt between date '1999-08-01' and date '{END}'"


def sql(select: str, *groups: dict[str, str]) -> str:
    steps = dict(ROLES)
    for g in groups:
        steps.update(g)
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in steps.items()) + "\n" + select


def fit_sql(model: str, *groups: dict[str, str], after: dict[str, str] | None = None, select: str = "select * from cdt") -> str:
    """Every step is computed once; a model's steps may refer to themselves."""
    steps = dict(ROLES)
    for g in groups:
        steps.update(g)
    steps["cdt"] = f"""
        select scope_id, name as attdesc, round(weight / nullif(max(weight) over (partition by scope_id), 0), 5) as "Estimate", '{model}' as "SimulationType"
        from weights"""
    steps |= after or {}
    said = ",\n".join(f"{k} as {'' if k == 'descent' else 'materialized '}({v})" for k, v in steps.items())
    return f"with recursive {said}\n{select}"

SWITCHING = "select scope_id, src_item_id, dst_item_id, round(switching_prob, 6) as switching_prob, model from "


def all_statements() -> dict[str, str]:
    sku, brand, day = order_steps(), order_steps("brand"), order_steps(by_day=True)
    attrs, more = attr_steps(), attr_steps("more_attrs")
    in_window = f"valid = 1 and sale_ord_dt between date '{START}' and date '{END}'"
    tampered = {"tampered": """
        select scope_id as found_in, case when c3 = 'PROMO' and src_item_id > '5' then 'stray' else scope_id end as scope_id,
               case c3 when 'ECONOMY' then switching_prob + 1 when 'LARGE' then -switching_prob when 'MEDIUM' then 0.5 else switching_prob end as p
        from switching join (select scope_id, c3 from scopes) using (scope_id)""",
        "checked": """
        select s.scope_id, case when count_if(t.scope_id <> t.found_in) > 0 or max(t.p) > 1 or min(t.p) < 0
                                  or (count(*) >= 50 and max(t.p) = min(t.p)) then 1 else 0 end as switch_check
        from scopes s left join tampered t on t.found_in = s.scope_id group by all"""}

    status = f"""
        select scope_id, '0' as input_check, cast(n as varchar) as sku_number, cast(w as varchar) as switch_check, cast(c as varchar) as cdt_check,
               case when w = 0 and c = 0 then '0' else '1' end as status
        from (select s.scope_id,
                     (select count(*) from skus k where k.cid3 = s.c3 and k.sku_type = 'self' and k.item_sku_id in ({SOLD_RECENTLY})) as n,
                     (select case when max(switching_prob) > 1 or min(switching_prob) < 0 or (count(*) >= 50 and max(switching_prob) = min(switching_prob))
                             then 1 else 0 end from switching x where x.scope_id = s.scope_id) as w,
                     (select case when max("Estimate") <> 1 or count("Estimate") < count(*) then 1 else 0 end from cdt x where x.scope_id = s.scope_id) as c
              from scopes s
              where (select count(distinct date_trunc('month', o.sale_ord_dt)) from order_lines o
                     where o.cid3 = s.c3 and o.valid = 1 and o.sale_ord_dt between date '1999-08-01' and date '{END}') = 24)
        union all
        select scope_id, '1', '-1', '1', '1', '1' from scopes s
        where (select count(distinct date_trunc('month', o.sale_ord_dt)) from order_lines o
               where o.cid3 = s.c3 and o.valid = 1 and o.sale_ord_dt between date '1999-08-01' and date '{END}') < 24
        union all select '{GHOST}', '1', '-1', '1', '1', '1'"""

    def scan(variant, rule):
        return f"select '{variant}' as variant, o_orderkey, cast(o_orderdate as date) as dt from orders where {rule}"

    keys, at = "o_orderpriority in ('1-URGENT', '5-LOW')", "cast(o_orderdate as date)"
    return {
        "order_scan": sql(f"""select user_id, parent_sale_ord_id, item_sku_id, sale_ord_id, sale_ord_dt, sale_qtty,
            round(cast(after_amt as double), 4) as after_prefr_amount, round(cast(before_amt as double), 2) as before_prefr_amount
            from order_lines where {in_window} and cid3 in ('ECONOMY', 'PROMO')"""),
        "sku_type": sql("select item_sku_id, sku_name, cid3, sku_type from skus"),
        "partition_scan": " union all ".join([
            scan("assortment", f"{at} <= date '1998-03-15' and {keys}"), scan("match", f"{at} = date '1998-03-15' and {keys}"),
            scan("brand_mapping", f"{at} = date '1998-03-15' and {keys} and o_orderstatus = 'F'"),
            scan("profit_loss", f"{at} between date '1998-01-01' and date '1998-03-15' and {keys}"),
            scan("past_assortment", f"{at} < date '1998-03-15' and {keys}"), scan("forecast", keys),
            scan("brand_dict", f"{at} = date '1998-03-15'"), scan("category_role", "true")]),
        "ext_attr_scan": """select p_size % 4 as data_type, cast(p_partkey as varchar) as item_sku_id, 'colour' as com_attr_name,
            split_part(p_name, ' ', 1) as com_attr_value_name, p_type as cate_id, '2001-07-31' as dt
            from part where p_partkey % 3 <> 0 and p_type in ('SMALL', 'LARGE', 'MEDIUM') and p_size % 4 <> 2""",
        "view_scan": sql("select item_sku_id, user_log_acct, request_dt, session_id from clicks"),
        "tsv_null_rows": """select cast(p_partkey as varchar) as item_sku_id, case when p_partkey % 11 > 4 then p_name end as sku_name,
            case when p_partkey % 5 <> 0 then p_size end as size, '"' || p_brand as brand from part where p_partkey % 13 <> 0""",
        "tsv_rejects": """
            select case when reason is null then 'row' else 'reject' end as kind, case when reason is null then cast(k as varchar) end as item_sku_id,
                   case when reason is null then name end as sku_name, case when reason is null and k % 7 <> 1 then cast(p_size as bigint) end as size,
                   case when reason is null then round(cast(price as double), 2) end as price, case when reason is not null then line end as line, reason
            from (select *, case when k % 13 = 0 then 'columns: 5' when k % 13 = 1 then 'columns: 2' when k % 7 = 0 then 'type: size'
                                 when k % 17 = 0 then 'missing: item_sku_id' end as reason,
                         case when k % 13 = 0 then whole || chr(9) || 'more' when k % 13 = 1 then cast(k as varchar) || chr(9) || p_name else whole end as line
                  from (select *, concat_ws(chr(9), case when k % 17 = 0 then 'NA' else cast(k as varchar) end, name,
                                            case when k % 7 = 0 then 'big' when k % 7 = 1 then 'NULL' else cast(p_size as varchar) end, cast(price as varchar)) as whole
                        from (select p_partkey as k, p_name, replace(p_name, 'a', 'N/A') as name, p_size, cast(p_retailprice as decimal(18,2)) as price from part)))
            where k % 13 <> 2""",
        "pending_scopes": sql("select dt, cid3 from control where status = '0'"),
        "time_frame": """
            select day, cast(date_trunc('month', day) as date) - 1 as default_end,
                   cast(date_trunc('month', day) - interval 6 year as date) as default_start,
                   cast(date_trunc('month', day) + interval 1 month - interval 6 year as date) as start_date, day + 1 as publish_date,
                   cast(ceil((date_diff('day', date '1995-01-01', day) + 1) / 7.0) as bigint) as week
            from (select distinct cast(o_orderdate as date) as day from orders)""",
        "category_enrich": sql("""
            select string_agg(coalesce(t.c1, '0'), '-' order by n) as item_first_cate_cd, string_agg(coalesce(t.c2, '0'), '-' order by n) as item_second_cate_cd,
                   l.codes as item_third_cate_cd, string_agg(coalesce(t.name, 'None'), '-' order by n) as scope_desc
            from (select codes, unnest(string_split(codes, '-')) as code, generate_subscripts(string_split(codes, '-'), 1) as n from lists) l
            left join tree t on t.c3 = l.code group by l.codes""", {"lists": """
            select distinct c || case when cast(user_id as bigint) % 10 = 0 then '-GIFT' else '' end as codes
            from (select parent_sale_ord_id, user_id, string_agg(distinct cid3, '-' order by cid3) as c from order_lines group by 1, 2)"""}),
        "scope_table": sql(f"""select scope_id as id, c1 as item_first_cate_cd, c2 as item_second_cate_cd, c3 as item_third_cate_cd, self_pop,
            scope_type, scope_desc, item_type, scope_id as super_scope_id from ({scope_sql('self', 'sku')} union all {scope_sql('pop', 'brand')})"""),
        "lvl4_scopes": sql(f"""select scope_id, replace(scope_id, 'lvl4', 'super') as super_scope_id, c3 as item_third_cate_cd, scope_type,
            scope_desc from ({SUB_SCOPES})"""),
        "seller_scope": sql(f"""select s.scope_id, o.item_sku_id, count(*) as n_lines from order_lines o join skus k using (item_sku_id)
            join ({scope_sql('self', 'sku')} union all {scope_sql('pop', 'sku')} union all {scope_sql('all', 'sku')}) s on s.c3 = o.cid3
             and k.sku_type <> 'other' and (s.self_pop = 'all' or s.self_pop = k.sku_type) where {in_window} group by all"""),
        "seller_scope_history": sql(f"""select s.scope_id, o.item_sku_id, count(*) as n_lines from order_lines o join skus k using (item_sku_id)
            join ({scope_sql('self', 'sku')} union all {scope_sql('pop', 'sku')} union all {scope_sql('all', 'sku')}) s on s.c3 = o.cid3
             and k.sku_type <> 'other' and (s.self_pop = 'all' or s.self_pop = k.sku_type) where {in_window} group by all"""),
        "lvl4_scope": sql(f"""select s.scope_id, o.item_sku_id, count(*) as n_lines from order_lines o join skus k using (item_sku_id)
            join fourth f on f.sku_id = o.item_sku_id join ({SUB_SCOPES}) s on s.c3 = o.cid3 and s.scope_desc = f.attr_value
            where k.sku_type = 'self' and {in_window} group by all"""),
        "customer_orders": sql("select * from customers", sku),
        "customer_filter": sql("""select f.scope_id, f.user_id, count(*) as n_lines from facts f join customers c using (scope_id, user_id)
            where c.ord_qtty between 2 and 24 and f.user_id <> '-1' group by all""", sku),
        "nonpromo_filter": sql(f"""select sale_ord_id, item_sku_id, round(cast(after_amt as double), 4) as after_prefr_amount,
            round(cast(before_amt as double), 2) as before_prefr_amount from order_lines
            where {in_window} and sale_qtty > 0 and before_amt > 0 and after_amt >= 0.95 * before_amt"""),
        "prod_tail": sql("select scope_id, item_sku_id, qty as sale_qtty, round(cum_ratio, 6) as cum_ratio from tail", sku),
        "brand_map": sql("select * from brand_of"),
        "competitor_price": """select cast(p_partkey as varchar) as sku, round(cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / sum(l_quantity), 6) as mean_price
            from part join lineitem on l_partkey = p_partkey where p_partkey % 5 = 0 and p_partkey % 3 <> 0 group by p_partkey""",
        "sku_in_scope": sql("""select distinct k.scope_id, k.item_sku_id, k.item_sku_id as item_id, s.sku_name as item_name, 'sku' as item_type
            from kept k join skus s using (item_sku_id)""", sku),
        "sku_in_scope_brand": sql("""select distinct k.scope_id, k.item_sku_id, m.item_id, m.item_name, 'brand' as item_type
            from kept k left join brand_of m using (item_sku_id)""", brand),
        "sku_in_scope_log": sql("""select distinct l.scope_id, s.item_sku_id, l.src_item_id as item_id, s.sku_name as item_name, 'sku' as item_type
            from log_switching l join skus s on s.item_sku_id = l.src_item_id where l.src_item_id = l.dst_item_id""", log_steps()),
        "item_min_sales": sql("select scope_id, item_id, round(cast(amount as double), 2) as sale_amount from big_items", sku),
        "active_weeks": sql("select * from weeks", sku),
        "items_in_scope": sql("select i.scope_id, i.item_id, b.n as item_ord_count from items i join item_baskets b using (scope_id, item_id)", sku),
        "basket_seq": sql("select distinct scope_id, user_id, parent_sale_ord_id, item_id, seq as seqnum from numbered", sku),
        "basket_seq_day": sql("select distinct scope_id, user_id, sale_ord_dt, item_id, seq as seqnum from numbered", day),
        "basket_items": sql("select scope_id, user_id, seq as seqnum, item_id, qty as sale_qtty, amt as before_prefr_amount from basket", brand),
        "basket_totals": sql("select scope_id, user_id, seq as seqnum, total as basket_amount, n as item_count from totals", sku),
        "spendswitch": sql("""select r.scope_id, r.src, r.dst, round(r.src_amt, 2) as src_amount, round(r.dst_amt, 2) as dst_amount, round(r.ss, 4) as spendswitch
            from raw r join items i on i.scope_id = r.scope_id and i.item_id = r.src join items j on j.scope_id = r.scope_id and j.item_id = r.dst""", sku),
        "theil_index": sql("select scope_id, user_id, round(t, 6) as t, round(comp, 6) as comp_index from theil", sku),
        "within_spendswitch": sql("""select scope_id, user_id, src, dst, round(src_amt, 2) as src_amount, round(dst_amt, 2) as dst_amount,
            round(ss, 4) as spendswitch from inside""", brand),
        "comp_rate": sql("select scope_id, src, dst, round(cr, 6) as cr from comp", brand),
        "spendswitch_ca": sql("select scope_id, src, dst, round(cr, 6) as cr, round(ca, 4) as spendswitch_ca from adjusted", brand),
        "lift_ci": sql("""select scope_id, src, dst, ab as ab_count, src_n as src_baskets, dst_n as dst_baskets, round(ci, 6) as ci
            from adjusted where ab is not null""", brand),
        "spendswitch_ad": sql("select scope_id, src, dst, round(ci, 6) as ci, round(ad, 4) as spendswitch_ad from adjusted", sku),
        "spendswitch_detail": sql("""select a.dst as item_id, a.src as from_item_id, round(a.dst_amt, 2) as before_prefr_amount,
            round(a.src_amt, 2) as from_before_prefr_amount, round(a.ss, 4) as spendswitch, round(cast(a.cr as double), 6) as cr,
            round(a.ca, 4) as spendswitch_ca, round(a.ci, 6) as ci, round(a.ad, 4) as spendswitch_ad, round(s.total, 4) as spendswitch_sum,
            round(a.ad / s.total, 6) as switch_prob, a.scope_id, 'order' as model
            from adjusted a join sums s on s.scope_id = a.scope_id and s.src = a.src""", order_steps(entropy=False)),
        "switch_prob_order": sql(SWITCHING + "switching", sku),
        "switch_prob_order_brand": sql(SWITCHING + "switching", brand),
        "switch_prob_order_day": sql(SWITCHING + "switching", day),
        "switch_prob_order_mixed": sql(SWITCHING + "switching", mixed_steps()),
        "sku_in_scope_mixed": sql("""select distinct k.scope_id, k.item_sku_id, case when s.item_type = 'sku' then k.item_sku_id else m.item_id end as item_id,
            case when s.item_type = 'sku' then n.sku_name else m.item_name end as item_name, s.item_type
            from kept k join scopes s using (scope_id) join skus n using (item_sku_id) left join brand_of m using (item_sku_id)""", mixed_steps()),
        "coview_counts": sql("select w.scope_id, m.* from met m, whole w", log_steps()),
        "switch_prob_log": sql(SWITCHING + "log_switching", log_steps()),
        "switch_prob_log_brand": sql(SWITCHING + "log_switching", log_steps("brand")),
        "pair_base": sql(f"select {PAIR}, round(switching_prob, 6) as switching_prob from pairs", sku, PAIR_STEPS),
        "attr_split": sql("""select a.scope_id, a.attr_key, a.item_id, case when not k.numeric then a.attr_val end as text_val,
            case when k.numeric then try_cast(a.attr_val as double) end as num_val from sattr a join kinds k using (scope_id, attr_key)""", attrs),
        "attr_split_dirty": sql("""
            select a.scope_id, a.attr_key, a.item_id, case when not k.numeric then a.v end as text_val,
                   case when k.numeric then try_cast(a.num as double) end as num_val
            from judged a join (select scope_id, attr_key, count(v) > 0 and count(v) = count(num) as numeric from judged group by all) k
              using (scope_id, attr_key)""", {"scope3": scope_sql("self", "sku"), "dirty": """
            select cast(p_partkey as varchar) as item_id, attr_key,
                   case attr_key when 'spelled' then case p_partkey % 5 when 0 then '1e2' when 1 then '+3.' when 2 then '.5' when 4 then '-0.25' end
                                 when 'infinite' then case when p_partkey % 3 = 0 then 'Infinity' else cast(p_partkey % 10 as varchar) end
                                 when 'suffixed' then case when p_partkey % 3 = 0 then '5d' else cast(p_partkey % 10 as varchar) end
                                 else case when p_partkey % 3 <> 0 then cast(p_partkey % 10 as varchar) end end as v
            from part, (values ('spelled'), ('not a number'), ('infinite'), ('suffixed'), ('blank')) t(attr_key)""", "judged": """
            select s.scope_id, d.attr_key, d.item_id, d.v, case when d.v not in ('Infinity', '5d') then d.v end as num
            from dirty d join skus k on k.item_sku_id = d.item_id and k.sku_type = 'self' join scope3 s on s.c3 = k.cid3"""}),
        "attr_collapse": sql("""select a.scope_id, a.attr_key, k.p_brand as item_id, max(a.attr_val) as attr_val from sattr a
            join skus k on k.item_sku_id = a.item_id group by all""", attrs),
        "attr_filter": sql(f"""select s.scope_id, a.attr_name as attr_key, a.sku_id as item_id, a.attr_value as attr_val from attrs a
            join skus k on k.item_sku_id = a.sku_id and k.sku_type = 'self' join fourth f on f.sku_id = a.sku_id
            join ({SUB_SCOPES}) s on s.c3 = k.cid3 and s.scope_desc = f.attr_value
            where a.web_id < 2 and a.attr_name not in ('noun', 'size') and not (a.attr_name = 'colour' and s.scope_desc in ('bolt', 'ring'))"""),
        "attr_dedupe": sql("select * from kept_keys", more),
        "attr_categorical": sql(f"select {PAIR}, attr_key, round(similarity, 6) as similarity from cat_sim", sku, attrs, PAIR_STEPS),
        "attr_numeric": sql(f"select {PAIR}, attr_key, round(similarity, 6) as similarity from num_sim", sku, more, PAIR_STEPS),
        "pair_sales": sql(f"""select {PAIR}, round(switching_prob, 6) as switching_prob, round(from_sales, 4) as "fromSales",
            round(to_sales, 4) as "toSales" from sales""", sku, PAIR_STEPS),
        "pair_sales_brand": sql("""
            select p.scope_id, p.src_item_id, p.dst_item_id, round(p.switching_prob, 6) as switching_prob,
                   round(coalesce(a.sales, avg(a.sales) over (partition by p.scope_id)), 4) as "fromSales",
                   round(coalesce(b.sales, avg(b.sales) over (partition by p.scope_id)), 4) as "toSales"
            from pairs p left join brand_net a on a.scope_id = p.scope_id and a.item_id = p.src_item_id
            left join brand_net b on b.scope_id = p.scope_id and b.item_id = p.dst_item_id""", brand, {"pairs": PAIR_STEPS["pairs"], "brand_net": f"""
            select s.scope_id, m.item_id, cast(sum(o.after_amt) as double) as sales
            from order_lines o join brand_of m on m.item_sku_id = o.item_sku_id and m.item_id is not null join scopes s on s.c3 = o.cid3
            where o.valid = 1 and o.sale_ord_dt between date '{START}' and date '{END}' group by all"""}),
        "attr_matrix": sql("""
            select s.scope_id, s.src_item_id, s.dst_item_id, round(any_value(s.switching_prob), 6) as "switchProb",
                   """ + "".join(f"""round(max(case when x.attr_key = '{k}' then x.similarity end), 6) as "{k}",
                   """ for k in ("colour", "noun", "price", "size", "volume", "品牌")) + """
                   round(any_value(s.from_sales), 4) as "fromSales", round(any_value(s.to_sales), 4) as "toSales"
            from sales s left join (select * from cat_sim union all select * from num_sim) x using (scope_id, src_item_id, dst_item_id)
            group by 1, 2, 3""", sku, more, PAIR_STEPS),
        "cdt_translate": sql("""
            select a.scope_id, coalesce(nullif(k.shown_as, ''), d.name, a.attr_key) as attdesc, count(distinct a.item_id) as n_items
            from sattr a left join kept_keys k using (scope_id, attr_key)
            left join (values ('price', '价格'), ('unit', '包装件数'), ('volume', '总容量/总重量'), ('unit_volume', '单件容量/单件重量'),
                ('unit_price', '单件价格'), ('per_price', '单位容量价格/单位重量价格')) d(key, name) on d.key = a.attr_key
            group by a.scope_id, a.attr_key, k.shown_as, d.name""", more),
        "cdt_rf": fit_sql(FOREST, sku, more, PAIR_STEPS, FIT_STEPS, forest_steps()),
        "cdt_enet": fit_sql("Elastic Net Regression", sku, more, PAIR_STEPS, FIT_STEPS, net_steps()),
        "scope_counts_monthly": sql("""
            unpivot (select "window", scope_id, count(distinct parent_sale_ord_id) as orders, count(distinct item_sku_id) as skus,
                            count(distinct user_id) as customers from window_facts group by all)
            on orders, skus, customers into name kind value n""", sku, WINDOW_STEPS),
        "customer_orders_monthly": sql("""
            select "window", scope_id, user_id, count(distinct parent_sale_ord_id) as ord_qtty from window_facts group by all""", sku, WINDOW_STEPS),
        "prod_tail_monthly": sql("""
            select "window", scope_id, item_sku_id, qty as sale_qtty, round(cum_ratio, 6) as cum_ratio from (
              select *, sum(qty) over (partition by "window", scope_id order by qty desc, item_sku_id
                       rows between unbounded preceding and current row) / sum(qty) over (partition by "window", scope_id) as cum_ratio
              from (select "window", scope_id, item_sku_id, sum(sale_qtty) as qty from window_facts group by all))
            where cum_ratio <= 0.95""", sku, WINDOW_STEPS),
        "month_coverage_monthly": sql("select * from coverage", FINE_STEPS),
        "month_coverage": sql("select * from coverage", FINE_STEPS),
        "input_check": sql("""
            select f.scope_id, cast(case when (select count(*) from coverage c where c.scope_id = f.scope_id and c.n_lines = 0) = 0
                and exists (select 1 from fine_skus k join attrs a on a.sku_id = k.item_sku_id where k.fine = f.fine)
                then 0 else 1 end as bigint) as input_check from fine f union all select '1_11_GHOST_self_lvl3_GHOST_sku', 1""", FINE_STEPS),
        "sku_number": sql(f"""
            select s.scope_id, count(distinct k.item_sku_id) as sku_number from ({scope_sql('self', 'sku')}) s
            left join (select * from skus where sku_type = 'self' and item_sku_id in ({SOLD_RECENTLY})) k on k.cid3 = s.c3 group by all
            union all select s.scope_id, count(distinct f.sku_id) from ({SUB_SCOPES}) s
            left join fourth f on f.cid3 = s.c3 and f.attr_value = s.scope_desc group by all"""),
        "switch_check": sql("select scope_id, cast(switch_check as bigint) as switch_check from checked", sku, tampered),
        "cdt_check": fit_sql(FOREST, sku, more, PAIR_STEPS, FIT_STEPS, forest_steps(), select="""
            select s.scope_id, cast(case when x.bad then 1 else 0 end as bigint) as cdt_check from scopes s left join (
              select c.scope_id, c3 = 'MEDIUM' and count_if(attdesc = 'colour') > 0 or c3 = 'LARGE' or c3 = 'SMALL' and count_if(attdesc = 'colour') > 0
                     or c3 = 'PROMO' and count_if(attdesc = 'colour') > 0 or count("Estimate") < count(*) or max("Estimate") <> 1 as bad
              from cdt c join scopes using (scope_id) group by c.scope_id, c3) x on x.scope_id = s.scope_id"""),
        "status_table": fit_sql(FOREST, sku, more, PAIR_STEPS, FIT_STEPS, forest_steps(), after={"status": status}, select="select * from status"),
        "status_sink": fit_sql(FOREST, sku, more, PAIR_STEPS, FIT_STEPS, forest_steps(), after={"status": status}, select="""
            select s.*, d.dt, split_part(scope_id, '_', 3) as cid3 from status s, (values ('2001-07-01'), ('2001-08-01')) d(dt)"""),
        "cdt_sink": fit_sql(FOREST, sku, more, PAIR_STEPS, FIT_STEPS, forest_steps(), select="""
            select 'key' as kind, scope_id, attdesc, "Estimate", "SimulationType", '2001-08-01' as dt, split_part(scope_id, '_', 3) as cid3 from cdt
            union all
            select 'name', c.scope_id, coalesce(nullif(k.shown_as, ''), d.name, c.attdesc), "Estimate", "SimulationType", '2001-08-01', split_part(c.scope_id, '_', 3)
            from cdt c left join kept_keys k on k.scope_id = c.scope_id and k.attr_key = c.attdesc
            left join (values ('price', '价格'), ('unit', '包装件数'), ('volume', '总容量/总重量')) d(key, name) on d.key = c.attdesc"""),
        "publish_gate": sql(SWITCHING + "switching where scope_id in (select scope_id from checked where switch_check = 0)", sku, tampered),
        "publish_roundtrip": sql("""
            select w.scope_id, w.src_item_id, w.dst_item_id, round(w.switching_prob, 6) as switching_prob,
                   case when s.c3 = 'SMALL' then 'old' else w.model end as model, '2001-08-01' as dt, s.c3 as cid3
            from switching w join scopes s using (scope_id)""", sku),
        "publish_rerun": sql("""
            select w.scope_id, w.src_item_id, w.dst_item_id, round(w.switching_prob, 6) as switching_prob,
                   case when s.c3 = 'PROMO' then w.model else 'old' end as model, '2001-08-01' as dt, s.c3 as cid3
            from switching w join scopes s using (scope_id) where s.c3 not in ('ECONOMY', 'SMALL')""", sku),
        "publish_interrupted": sql("""
            select w.scope_id, w.src_item_id, w.dst_item_id, round(w.switching_prob, 6) as switching_prob,
                   case when s.c3 = 'PROMO' then w.model else 'old' end as model, '2001-08-01' as dt, s.c3 as cid3
            from switching w join scopes s using (scope_id)""", sku),
        "spendswitch_sink": sql("""select a.dst as item_id, a.src as from_item_id, round(a.ss, 4) as spendswitch, round(a.ad, 4) as spendswitch_ad,
            round(s.total, 4) as spendswitch_sum, round(a.ad / s.total, 6) as switch_prob, a.scope_id, 'order' as model, '2001-07-31' as dt, c.c3 as cid3
            from adjusted a join sums s on s.scope_id = a.scope_id and s.src = a.src join scopes c on c.scope_id = a.scope_id
            where c.c3 in ('ECONOMY', 'PROMO')""", order_steps(entropy=False)),
        "sku_in_scope_sink": sql("""
            select x.*, c.name as scope_desc, '2001-07-31' as dt, c.c3 as cid3 from (
              select distinct k.scope_id, k.item_sku_id, k.item_sku_id as item_id, s.sku_name as item_name, 'sku' as item_type
              from kept k join skus s using (item_sku_id)
              union all select distinct replace(k.scope_id, '_sku', '_brand'), k.item_sku_id, m.item_id, m.item_name, 'brand'
              from kept k left join brand_of m using (item_sku_id)) x join tree c on c.c3 = split_part(x.scope_id, '_', 3)""", sku),
        "mark_done": sql("select case when cid3 <> '5-LOW' then '1' else status end as status, dt, cid3 from control"),
    }
