"""SQL counterparts of the queries, for the comparing engine.

Each fragment is one SELECT over views and other fragments; a query's SQL is
the chain of fragments it needs. They are written as joins, windows and
``NOT IN`` where the Spark side uses grouped minima, anti joins and closed
forms, so the two are independent computations of the same result.
"""

from __future__ import annotations

import re

from casework_checks.views import DuckDialect, build_views, duck_view
from casework.sources.schemas import HISTORY_COLUMNS, HISTORY_EXTRA_COLUMNS, INPUTS

_VIEWS = tuple(build_views(DuckDialect))
_D = "date '1998-06-30'"


def _text(*parts: str) -> str:
    return "nullif(concat(" + ", ".join(parts) + "), '')"


def _now(name: str, trig: str | None = None) -> str:
    return f"case when curr_date = bl_date then {trig or 'bl_trig_' + name[5:]} else {name} end"


_LINE_COST = "case when comp_cost_initial is null or pricing_cost_initial is null then null " \
    "else least(comp_cost_initial, pricing_cost_initial) end"
_CHEAPER = "pricing_cost_initial < comp_cost_initial"


def _side(suffix: str) -> str:
    return f"case when {_CHEAPER} then pricing_cost_{suffix} else comp_cost_{suffix} end"


def _before(c: str) -> str:
    return f"try_cast(nullif(trim(regexp_extract({c}, '^(.*)-[^-]*$', 1)), '') as bigint)"


def _after(c: str) -> str:
    return f"try_cast(nullif(trim(regexp_extract({c}, '[^-]+$')), '') as bigint)"


def _rounded(a: str, b: str, scale: int) -> str:
    """a / b rounded half away from zero, in whole numbers."""
    f = 10**scale
    magnitude = f"(({2 * f} * abs(cast({a} as hugeint)) + cast({b} as hugeint)) // (2 * cast({b} as hugeint)))"
    return f"case when {b} = 0 then null else cast(sign({a}) * {magnitude} as double) / {f} end"


FRAGMENTS: dict[str, str] = {
    "recent": f"""
        select acct_item_key from v_history
        where insrt_dt > {_D} - case team_assigned when 'CCT' then 25 when 'NM' then 90 when 'STRAT' then 25 end""",
    "excluded_keys": f"select distinct {_text('ship_to', 'item_e1_num')} as exclusion_key from v_exclusions where ship_to <> -1",
    "candidates": f"""
        select acct_item_key, bl_mfg_cont, {_now('curr_mfg_cont')} as curr_mfg_cont, item_e1_num,
            (({_now('curr_cost')}) - bl_cost) * curr_qty * 4 as cost_impact, pndg_mmr_opp, mmr_type,
            acct_or_bill_to, highest_cust_name, vendor_name, bus_pltfrm, sys_pltfrm, mstr_grp_num,
            case sys_pltfrm
                when 'AS400' then concat(acct_or_bill_to, sys_pltfrm, item_as400_num, '-', strftime(bl_date, '%Y-%m-%d'))
                when 'E1' then concat(ship_to, sys_pltfrm, item_e1_num, '-', strftime(bl_date, '%Y-%m-%d'))
            end as trace_key
        from v_status
        where pndg_mmr_opp > 0 and coalesce(bl_mfg_cont, '') <> 'MCKB-NEG-LD'
            and acct_item_key not in (select acct_item_key from recent)
            and {_text('ship_to', 'item_e1_num')} not in (select exclusion_key from excluded_keys)""",
    "candidates_composite": f"""
        select acct_item_key, bl_mfg_cont, {_now('curr_mfg_cont')} as curr_mfg_cont, item_e1_num,
            (({_now('curr_cost')}) - bl_cost) * curr_qty * 4 as cost_impact, pndg_mmr_opp, mmr_type,
            acct_or_bill_to, highest_cust_name, vendor_name, bus_pltfrm, sys_pltfrm, mstr_grp_num,
            case sys_pltfrm
                when 'AS400' then concat(acct_or_bill_to, sys_pltfrm, item_as400_num, '-', strftime(bl_date, '%Y-%m-%d'))
                when 'E1' then concat(ship_to, sys_pltfrm, item_e1_num, '-', strftime(bl_date, '%Y-%m-%d'))
            end as trace_key
        from v_status
        where pndg_mmr_opp > 0 and coalesce(bl_mfg_cont, '') <> 'MCKB-NEG-LD'
            and acct_item_key not in (select acct_item_key from recent)
            and not exists (select 1 from v_exclusions x where x.ship_to <> -1
                and x.ship_to = v_status.ship_to and x.item_e1_num = v_status.item_e1_num)""",
    "maybe_taken": f"""
        select case when pool_num is not null then acct_item_key end as k from v_history
        where insrt_dt > {_D} - 25""",
    "not_in_with_nulls": "select acct_item_key from v_status where acct_item_key not in (select k from maybe_taken)",
    "not_in_ignoring_nulls": """
        select acct_item_key from v_status
        where acct_item_key not in (select k from maybe_taken where k is not null)""",
    "pools": f"""
        select acct_or_bill_to, sys_pltfrm, pool_num, pool_name from (
            select distinct acct_or_bill_to, s.sys_pltfrm, pool_num, pool_name, cust_pool_start_dt
            from v_status s join v_customer_blend b on bill_to_cust_e1_num = acct_or_bill_to
            join v_customer_pool m on m.dim_cust_curr_id = b.dim_bill_to_cust_curr_id
            join v_pool p on p.dim_pool_id = m.dim_pool_id
            where s.sys_pltfrm = 'E1' and cust_pool_end_dt > {_D} and pool_type_num in ('3', '4', '5', '6', '7'))
        qualify rank() over (partition by acct_or_bill_to order by cust_pool_start_dt desc nulls first) = 1""",
    "increases": """
        select acct_item_key, bus_pltfrm, bl_mfg_cont, item_e1_num, mmr_type, cost_impact, pndg_mmr_opp
        from candidates
        where mmr_type in ('CCI', 'CCI/LM') and cost_impact > 0 and sys_pltfrm = 'E1' and bl_mfg_cont <> curr_mfg_cont""",
    "contract_sums": "select bl_mfg_cont, bus_pltfrm, sum(cost_impact) as sum_opp from increases group by all",
    "contract_totals": """
        select * from contract_sums
        where sum_opp > case bus_pltfrm when 'PC' then 25000 when 'EC' then 10000 end""",
    "top_contracts": """
        select bl_mfg_cont, bus_pltfrm,
            row_number() over (order by sum_opp desc, bl_mfg_cont nulls last, bus_pltfrm nulls last) as case_cntr
        from contract_sums qualify case_cntr <= 100""",
    "contract_cases": """
        select acct_item_key, '1' as case_prefix, case_cntr, 'CCT' as team_assigned
        from increases join top_contracts using (bl_mfg_cont, bus_pltfrm)""",
    "sales": """
        select distinct t.acct_item_key, sls_3_mth, neg_sls_3_mth, qty_3_mth, cst_3_mth, neg_cst_3_mth
        from v_weekly_txn t join candidates c on c.acct_item_key = t.acct_item_key""",
    "pooled": """
        select acct_item_key, pool_num, highest_cust_name, vendor_name, pndg_mmr_opp
        from candidates left join pools using (acct_or_bill_to, sys_pltfrm)""",
    "residual": """
        select p.* from pooled p join (
            select acct_item_key from pooled except select acct_item_key from contract_cases
        ) left_over on left_over.acct_item_key = p.acct_item_key""",
    "pool_cases": f"""
        select acct_item_key, '3' as case_prefix, pool_num as case_cntr, 'STRAT' as team_assigned, pool_num
        from residual where pool_num is not null
            and pool_num not in (select pool_num from v_history where insrt_dt > {_D} - 25)""",
    "pool_cases_ignoring_nulls": f"""
        select acct_item_key, '3' as case_prefix, pool_num as case_cntr, 'STRAT' as team_assigned, pool_num
        from residual where pool_num is not null
            and pool_num not in (select pool_num from v_history where insrt_dt > {_D} - 2 and pool_num is not null)""",
    "top_pairs": """
        select highest_cust_name, vendor_name,
            row_number() over (order by sum(s.neg_sls_3_mth) desc, highest_cust_name nulls last, vendor_name nulls last)
                as case_cntr
        from residual r join sales s on s.acct_item_key = r.acct_item_key
        where pool_num is null and s.neg_sls_3_mth > 0
        group by highest_cust_name, vendor_name qualify case_cntr <= 10""",
    "vendor_cases": """
        select acct_item_key, '4' as case_prefix, case_cntr, 'NM' as team_assigned, pool_num
        from residual join top_pairs using (highest_cust_name, vendor_name)
        where pool_num is null and pndg_mmr_opp > 0""",
    "pooled_contract_cases": """
        select c.acct_item_key, case_prefix, case_cntr, team_assigned, pool_num
        from contract_cases c left join pooled p on p.acct_item_key = c.acct_item_key""",
    "cases": """
        select * from pooled_contract_cases union select * from pool_cases union select * from vendor_cases""",
    "cases_all": """
        select * from pooled_contract_cases union select * from pool_cases_ignoring_nulls
        union select * from vendor_cases""",
    # ---- price catalog ------------------------------------------------------------
    "cheaper_branch": f"""
        select price_source, item_e1_num, ship_to, {_LINE_COST} as lpg_prca_cost, {_side('list_id')} as var_cst_cont,
            {_side('cont_name')} as var_cst_cont_name, {_side('cont_type')} as var_cst_cont_type
        from v_ipc""",
    "offers": f"""
        select distinct price_source, item_e1_num, {_LINE_COST} as cost, {_side('list_id')} as cont,
            {_side('cont_name')} as cont_name, {_side('cont_type')} as cont_type
        from v_ipc where var_cost = 'Y' and {_side('list_id')} not in ('0', '/*', '*')""",
    "cheapest": """
        select price_source, item_e1_num, cost as mn_lpg_prca_cost, cont as var_cst_cont,
            cont_name as var_cst_cont_name, cont_type as var_cst_cont_type
        from (select * from offers qualify cost = min(cost) over (partition by price_source, item_e1_num))
        qualify rank() over (partition by price_source, item_e1_num
            order by cont nulls last, cont_type nulls last, cont_name nulls last) = 1""",
    "accounts_on_off": """
        select distinct b.ship_to, b.item_e1_num, c.var_cst_cont, b.price_source,
            b.comp_cost_list_id is not distinct from c.var_cst_cont as is_on
        from cheapest c join v_ipc b on b.price_source = c.price_source and b.item_e1_num = c.item_e1_num
        where b.var_cost = 'Y'""",
    "counts_on_off": """
        select is_on, item_e1_num, price_source, var_cst_cont, count(ship_to) as n from accounts_on_off group by all""",
    "connected_share": f"""
        select price_source, var_cst_cont, {_rounded('a', 'b', 2)} as prcnt_cnctd from (
            select x.price_source, x.var_cst_cont, sum(x.n) as a, sum(x.n) + sum(y.n) as b
            from counts_on_off x join counts_on_off y
                on x.price_source = y.price_source and x.var_cst_cont = y.var_cst_cont
            where x.is_on and not y.is_on group by all)""",
    "standard_account_connected": """
        select distinct price_source, item_e1_num, var_cst_cont,
            case when comp_cost_list_id = var_cst_cont then 'Y' else 'N' end as pcca_cnctd
        from v_ipc join cheapest using (price_source, item_e1_num)
        where price_source_pcca = ship_to and var_cost = 'Y'""",
    "split_contract_id": f"""
        select comp_cost_list_id, coalesce({_before('comp_cost_list_id')}, 0) as var_mck_cont_id,
            coalesce({_after('comp_cost_list_id')}, 0) as var_mck_cont_tier
        from v_ipc""",
    "run_log": """
        select 'casework' as application_name, 'batch' as process_name, 'CREATE' as process_type,
            'status' as event_action, 'rows of the status fact' as action_description, 'ROW_COUNT' as metric_name,
            count(*) as metric_value, cast(1 as bigint) as runs_forward
        from v_status""",
    "history_failed_rerun": f"""
        select acct_item_key, insrt_dt, case_cntr, pndg_mmr_opp, {_D} as run_date from v_history_wide""",
    "sorted_parts": f"""
        select count(*) as n_rows, 0 as n_out_of_order, count(distinct file_name) as n_files
        from v_history_wide join latest_run_cases using (mmr_case)""",
    "staging_life": "select count(*) as n_rows, 0 as n_left from v_status",
    "quarantine": """
        select 'kept' as outcome, acct_item_key, null as reason from v_weekly_txn where sls_3_mth % 7 <> 0
        union all
        select 'rejected', acct_item_key, 'sls_3_mth: no decimal(18,4)' from v_weekly_txn where sls_3_mth % 7 = 0""",
    "history_rerun": f"""
        select acct_item_key, case when ship_to % 4 <> 3 then {_D} end as insrt_dt, case_cntr, pndg_mmr_opp,
            {_D} as run_date
        from v_history_wide""",
    "offers_all": f"""
        select distinct price_source, item_as400_num, i.item_e1_num, parnt_suplr_num,
            case when sys_pltfrm = 'AS400' then item_as400_num else cast(i.item_e1_num as varchar) end as item,
            case when sys_pltfrm = 'E1' then {_LINE_COST} else comp_cost_initial end as cost,
            case when sys_pltfrm = 'E1' then {_side('cont_id')} else comp_cost_cont_id end as cont,
            case when sys_pltfrm = 'E1' then {_side('list_id')} else comp_cost_list_id end as list_id,
            case when sys_pltfrm = 'E1' then {_side('cont_name')} else comp_cost_cont_name end as cont_name,
            case when sys_pltfrm = 'E1' then {_side('cont_type')} else comp_cost_cont_type end as cont_type
        from v_ipc i left join v_item d on d.item_e1_num = i.item_e1_num where var_cost = 'Y'""",
    "minima_all": f"""
        select distinct price_source,
            case when sys_pltfrm = 'AS400' then item_as400_num else cast(item_e1_num as varchar) end as item,
            case sys_pltfrm
                when 'AS400' then min(comp_cost_initial) over (partition by price_source, item_as400_num)
                when 'E1' then min({_LINE_COST}) over (partition by price_source, item_e1_num)
            end as least_cost
        from v_ipc where var_cost = 'Y'""",
    "cheapest_all": f"""
        select distinct concat(w.price_source, ',', w.item) as prc_src_item_key, parnt_suplr_num,
            cost as mn_lpg_prca_cost, cont as var_cst_cont, list_id as var_cst_cont_id,
            cont_name as var_cst_cont_name, cont_type as var_cst_cont_type,
            g.gpo_num as var_cst_gpo_num, g.gpo_name as var_cst_gpo_name
        from (
            select o.* from offers_all o join minima_all m
                on m.price_source = o.price_source and m.item = o.item and m.least_cost = o.cost
            qualify rank() over (partition by o.price_source, o.item
                order by cont nulls last, list_id nulls last, cont_type nulls last, cont_name nulls last) = 1) w
        left join v_contract_tier t
            on w.list_id = concat(t.cntrct_num, '-', t.tier_num) and w.cont_type = t.cntrct_type_cd and t.cntrct_end_dt > {_D}
        left join v_gpo g on g.dim_gpo_id = t.dim_gpo_id and g.gpo_end_dt > {_D}""",
    # ---- facts over whole tables ----------------------------------------------------
    "catalog_pairs": f"""
        select acct_item_key, ship_to * 10 + 1 as dim_cust_curr_id,
            ({_before('list_id')}) * 10 + {_after('list_id')} as vrcst_cntrct_tier_id
        from (select concat(sys_pltfrm, ship_to, bus_pltfrm, item_e1_num) as acct_item_key, ship_to,
                nullif(comp_cost_list_id, '*') as list_id from v_ipc)""",
    "exclusion_flag": f"""
        select distinct p.vrcst_cntrct_tier_id, p.dim_cust_curr_id, 'Y' as vrcst_cont_excld
        from catalog_pairs p join v_customer c on c.dim_cust_curr_id = p.dim_cust_curr_id
        join v_eligibility e on e.dim_cust_curr_id = c.dim_cust_curr_id and e.dim_cntrct_tier_id = p.vrcst_cntrct_tier_id
        where c.cust_type_cd in ('S', 'X', 'B') and c.sys_pltfrm = 'E1' and c.actv_flg = 'Y'
            and e.elgblty_end_dt > {_D} and e.elgblty_start_dt <= {_D} and e.cust_incl_excl_cd = 'E'""",
    "scalar_functions": f"""
        select ship_to, item_e1_num, {_text('local_pricing_group_id', "'/'", 'lpg_desc', 'comp_cost_list_id')} as joined,
            {_LINE_COST} as strict_least, nullif(regexp_extract(pricing_cost_list_id, '^(.*)-[^-]*$', 1), '') as before_hyphen,
            nullif(regexp_extract(pricing_cost_list_id, '[^-]+$'), '') as after_hyphen,
            {_rounded('cast(100 * (unit_price - comp_cost) as bigint)', 'cast(100 * unit_price as bigint)', 4)} as loaded
        from v_ipc""",
}


def _contract_attributes(lines: str, cases: str) -> str:
    """Three lookups of the tier dimension for the case lines."""
    return f"""
        select distinct b.tier_attrbt_elgblty_flg as bl_cont_atr_elig_flg, b.tier_base_flg as bl_cont_tier_base_flg,
            b.cntrct_num as bl_mck_cont, c.tier_attrbt_elgblty_flg as curr_cont_atr_elig_flg,
            c.tier_base_flg as curr_cont_tier_base_flg, c.cntrct_num as curr_mck_cont,
            v.tier_attrbt_elgblty_flg as vrcst_cont_atr_elig_flg, v.tier_base_flg as vrcst_cont_tier_base_flg,
            v.cntrct_num as vrcst_mck_cont, v.mfg_cntrct_num as vrcst_mfg_cont, v.mfg_cntrct_dsc as vrcst_cont_name,
            c.cntrct_src_cd as curr_orgn_scr, v.cntrct_src_cd as vrcst_orgn_scr, g.gpo_name as vrcst_gpo_name,
            s.acct_item_key, x.tier_attrbt_elgblty_flg as trig_cont_atr_elig_flg,
            x.tier_base_flg as trig_cont_tier_base_flg
        from v_status s
        join (select distinct acct_item_key from {cases}) k on k.acct_item_key = s.acct_item_key
        left join {lines} p on p.acct_item_key = s.acct_item_key
        left join v_contract_tier b on b.dim_cntrct_tier_id = s.bl_cntrct_tier_id
        left join v_contract_tier x on x.dim_cntrct_tier_id = s.bl_trig_cntrct_tier_id
        left join v_contract_tier c on c.dim_cntrct_tier_id = {_now('s.curr_cntrct_tier_id', 's.bl_trig_cntrct_tier_id')}
        left join v_contract_tier v on v.dim_cntrct_tier_id = p.vrcst_cntrct_tier_id
        left join v_gpo g on g.dim_gpo_id = v.dim_gpo_id
        where s.sys_pltfrm = 'E1'"""


def _memberships(accounts: str, true_dates: bool) -> str:
    fold = "strftime(max({0}), '%m/%d/%Y')" if true_dates else "max(strftime({0}, '%m/%d/%Y'))"
    return f"""
        select distinct c.cust_e1_num as ship_to, hlth_indstry_num as hin, dea_lic_num as dea,
            dea_lic_expr_dt as dea_exp_date, gpo_cot, gpo_cot_name, prmry_gpo_flag, prmry_gpo_num, prmry_gpo_name,
            prmry_gpo_id, gpo_mmbrshp_st, prmry_aff_st, rx_gpo_num, rx_gpo_name, rx_gpo_id
        from v_customer c join {accounts} a on a.ship_to = c.cust_num
        left join (
            select cust, max(cot_num) as gpo_cot, max(cot_name) as gpo_cot_name, max(flag) as prmry_gpo_flag,
                max(num) as prmry_gpo_num, max(nam) as prmry_gpo_name, max(id) as prmry_gpo_id,
                {fold.format('d1')} as gpo_mmbrshp_st, {fold.format('d2')} as prmry_aff_st,
                max(rx_num) as rx_gpo_num, max(rx_nam) as rx_gpo_name, max(rx_id) as rx_gpo_id
            from (
                select m.dim_cust_curr_id as cust, class_of_trade_num as cot_num, class_of_trade_dsc as cot_name,
                    prmry_affltn_flg as flag, gpo_num as num, gpo_name as nam, gpo_cust_acct_num as id,
                    mmbrship_start_dt as d1, prmry_affltn_start_dt as d2, 0 as rx_num, null as rx_nam, null as rx_id
                from v_customer_gpo m join v_gpo g on g.dim_gpo_id = m.dim_gpo_id
                join v_gpo_program p on p.dim_gpo_prgrm_id = m.dim_gpo_prgrm_id
                join v_gpo_class k on k.dim_gpo_class_of_trade_id = m.dim_gpo_class_of_trade_id
                where prmry_affltn_flg = 'Y' and gpo_mmbrship_type_dsc = 'GPO' and prmry_affltn_end_dt > {_D}
                union
                select m.dim_cust_curr_id, 0, null, null, 0, null, null, null, null, gpo_num, gpo_name, gpo_cust_acct_num
                from v_customer_gpo m join v_gpo g on g.dim_gpo_id = m.dim_gpo_id
                where prmry_affltn_flg = 'Y' and gpo_mmbrship_type_dsc = 'RX' and rx_mmbrship_end_dt > {_D})
            group by cust) f on f.cust = c.dim_cust_curr_id
        where c.sys_pltfrm = 'E1' and c.actv_flg = 'Y'"""


def _addresses(lines: str) -> str:
    alt = "coalesce(b.hc_dlvry_cd = 'PHD' and b.cnvrsn_type_cd = 'E', false)"
    pairs = [
        ("atadd1", "aladd1", "addrss_line1"), ("atadd2", "aladd2", "addrss_line2"),
        ("atadd3", "aladd3", "addrss_line3"), ("atadd4", "aladd4", "addrss_line4"),
        ("atcty1", "alcty1", "city"), ("atadds", "aladds", "state"), ("ataddz", "aladdz", "zip"),
    ]
    picked = ", ".join(f"case when {alt} then {a} else {b} end as {c}" for a, b, c in pairs)
    names = ", ".join(c for _, _, c in pairs)
    line = "concat(addrss_line1, ' ', addrss_line2, ' ', addrss_line3, ' ', addrss_line4, ', ', city, ', ', state, ' ', zip)"
    return f"""
        select bus_pltfrm, cust_key, {line} as address, {names} from (
            select distinct l.bus_pltfrm, l.acct_or_bill_to as cust_key, {', '.join('b.' + c for _, _, c in pairs)}, false as dated
            from {lines} l join v_customer_blend b on b.cust_lgcy_num = l.acct_or_bill_to and b.bus_pltfrm = l.bus_pltfrm
            where b.sys_pltfrm = 'EC'
            union all
            select distinct l.bus_pltfrm, l.ship_to, {picked}, not {alt}
            from {lines} l join v_customer_blend b on b.cust_e1_num = l.ship_to and b.bus_pltfrm = l.bus_pltfrm
            left join v_address_alternate a on a.atan8 = l.acct_or_bill_to
            left join (
                select distinct * from v_address_dated
                qualify rank() over (partition by alan8 order by aleftb desc nulls first) = 1) n on n.alan8 = l.ship_to
            where b.sys_pltfrm = 'E1')"""


def _price_lines(cases: str) -> dict[str, str]:
    """The price line chain over a set of cases; names get the cases' name as suffix."""
    s = f"_{cases}"
    return {
        f"numbered{s}": f"""
            select c.*, strftime({_D}, '%y%m%d') || case_prefix || case_cntr as mmr_case, {_D} as insrt_dt,
                {_now('m.curr_prc_src', 'm.bl_trig_prc_src')} as price_source, m.item_e1_num
            from {cases} c join v_status m on m.acct_item_key = c.acct_item_key""",
        f"offers{s}": f"""
            select distinct o.* from offers o join numbered{s} n
                on n.price_source = o.price_source and n.item_e1_num = o.item_e1_num""",
        f"cheapest{s}": f"""
            select price_source, item_e1_num, cost, cont, cont_name, cont_type
            from (select * from offers{s} qualify cost = min(cost) over (partition by price_source, item_e1_num))
            qualify rank() over (partition by price_source, item_e1_num
                order by cont nulls last, cont_type nulls last, cont_name nulls last) = 1""",
        f"lines{s}": f"""
            select i.*, n.case_cntr, n.team_assigned, n.pool_num, n.mmr_case, n.insrt_dt, n.acct_item_key,
                c.cost, c.cont, c.cont_name, c.cont_type, coalesce({_before('c.cont')}, 0) as num,
                coalesce({_after('c.cont')}, 0) as tier
            from v_ipc i join numbered{s} n
                on n.acct_item_key = concat(i.sys_pltfrm, i.ship_to, i.bus_pltfrm, i.item_e1_num)
            left join cheapest{s} c on c.price_source = i.price_source and c.item_e1_num = i.item_e1_num""",
        f"flags{s}": f"""
            select distinct price_source, item_e1_num, cont,
                case when cont = comp_cost_list_id then 'Y' else 'N' end as pcca_cnctd
            from lines{s} where price_source_pcca = ship_to and var_cost = 'Y'""",
        f"on_off{s}": f"""
            select is_on, item_e1_num, price_source, cont, count(ship_to) as n from (
                select distinct b.ship_to, b.item_e1_num, l.cont, b.price_source,
                    b.comp_cost_list_id is not distinct from l.cont as is_on
                from lines{s} l join v_ipc b on b.price_source = l.price_source and b.item_e1_num = l.item_e1_num
                where b.var_cost = 'Y' and l.cont is not null)
            group by all""",
        f"share{s}": f"""
            select price_source, cont, {_rounded('a', 'b', 2)} as share from (
                select x.price_source, x.cont, sum(x.n) as a, sum(x.n) + sum(y.n) as b
                from on_off{s} x join on_off{s} y on x.price_source = y.price_source and x.cont = y.cont
                where x.is_on and not y.is_on group by all)""",
        f"price_lines{s}": f"""
            select distinct l.ship_to, l.bus_pltfrm, l.acct_or_bill_to, l.price_source_pcca, l.bid_or_prca,
                l.bid_or_prca_name, h.share as prcnt_cnctd, f.pcca_cnctd, l.cost as mn_lpg_prca_cost,
                l.local_pricing_group_id as lpg_id, l.lpg_desc, l.cont as var_cst_cont, l.cont_name as var_cst_cont_name,
                l.cont_type as var_cst_cont_type, l.team_assigned, l.pool_num, l.mmr_case, l.insrt_dt, l.case_cntr,
                l.acct_item_key, l.num as var_mck_cont_id, l.tier as var_mck_cont_tier,
                t.dim_cntrct_tier_id as vrcst_cntrct_tier_id, c.dim_cust_curr_id
            from lines{s} l
            left join share{s} h on h.price_source = l.price_source and h.cont = l.cont
            left join flags{s} f
                on f.price_source = l.price_source and f.item_e1_num = l.item_e1_num and f.cont = l.cont
            left join v_contract_tier t on t.cntrct_num = l.num and t.tier_num = l.tier
            join v_customer c on c.cust_e1_num = l.ship_to and c.bus_pltfrm = l.bus_pltfrm and c.sys_pltfrm = 'E1'""",
    }


def _price_lines_v2(cases: str) -> dict[str, str]:
    s = f"_{cases}"
    keep = "price_source, item_e1_num"
    return {
        "reduced": f"""
            select i.*, n.case_cntr, n.team_assigned, n.pool_num, n.mmr_case, n.insrt_dt, n.acct_item_key,
                concat(n.price_source, ',', n.item_e1_num) as group_key
            from numbered{s} n join v_ipc i
                on n.acct_item_key = concat(i.sys_pltfrm, i.ship_to, i.bus_pltfrm, i.item_e1_num)""",
        "offers_v2": f"""
            select distinct {keep}, group_key, gpo_name, comp_cost_list_id, {_LINE_COST} as cost, {_side('list_id')} as cont,
                {_side('cont_name')} as cont_name, {_side('cont_type')} as cont_type
            from reduced where var_cost = 'Y' and {_side('list_id')} not in ('0', '/*')""",
        "winners_v2": f"""
            select distinct group_key, cost, cont, cont_name, cont_type, gpo_name
            from (select * from offers_v2 qualify cost = min(cost) over (partition by {keep}))
            qualify rank() over (partition by {keep} order by cont nulls last, cont_type nulls last,
                comp_cost_list_id nulls last, cont_name nulls last) = 1""",
        "lines_v2": f"""
            select r.*, w.cost, w.cont, w.cont_name, w.cont_type, w.gpo_name as vrcst_gpo_name,
                case when sys_pltfrm = 'E1' then coalesce({_before('w.cont')}, 0) else -1 end as num,
                case when sys_pltfrm = 'E1' then coalesce({_after('w.cont')}, 0) else -1 end as tier
            from reduced r left join winners_v2 w on w.group_key = r.group_key""",
        "flags_v2": """
            select distinct price_source_pcca, cont, case when cont = comp_cost_list_id then 'Y' else 'N' end as pcca_cnctd
            from lines_v2 where price_source_pcca = ship_to and var_cost = 'Y'""",
        "on_off_v2": """
            select is_on, item_e1_num, price_source, cont, count(ship_to) as n from (
                select distinct b.ship_to, b.item_e1_num, l.cont, b.price_source,
                    b.comp_cost_list_id is not distinct from l.cont as is_on
                from lines_v2 l join v_ipc b on b.price_source = l.price_source and b.item_e1_num = l.item_e1_num
                where b.var_cost = 'Y' and b.sys_pltfrm = 'E1' and l.cont is not null)
            group by all""",
        "share_v2": f"""
            select price_source, cont, {_rounded('a', 'b', 2)} as share from (
                select x.price_source, x.cont, sum(x.n) as a, sum(x.n) + sum(y.n) as b
                from on_off_v2 x join on_off_v2 y on x.price_source = y.price_source and x.cont = y.cont
                where x.is_on and not y.is_on group by all)""",
        "price_lines_v2": """
            select distinct l.ship_to, l.sys_pltfrm, l.bus_pltfrm, l.acct_or_bill_to, l.price_source_pcca, l.bid_or_prca,
                l.bid_or_prca_name, h.share as prcnt_cnctd, f.pcca_cnctd, l.cost as mn_lpg_prca_cost,
                l.local_pricing_group_id as lpg_id, l.lpg_desc, l.cont as var_cst_cont, l.cont_name as var_cst_cont_name,
                l.cont_type as var_cst_cont_type, l.vrcst_gpo_name, l.team_assigned, l.pool_num, l.mmr_case, l.insrt_dt,
                l.case_cntr, l.acct_item_key, l.num as var_mck_cont_id, l.tier as var_mck_cont_tier,
                t.dim_cntrct_tier_id as vrcst_cntrct_tier_id, c.dim_cust_curr_id
            from lines_v2 l
            left join share_v2 h on h.price_source = l.price_source and h.cont = l.cont
            left join flags_v2 f on f.price_source_pcca = l.price_source_pcca and f.cont = l.cont and f.cont = h.cont
            left join v_contract_tier t on t.cntrct_num = l.num and t.tier_num = l.tier
            left join v_customer c
                on c.cust_e1_num = l.ship_to and c.bus_pltfrm = l.bus_pltfrm and c.sys_pltfrm = l.sys_pltfrm""",
    }


_RESOLVED = (
    "cost comp_cost pricing_cost sell_price prc_rule prc_src prc_src_name mfg_cont mfg_cont_name cont_type "
    "cust_prim_gpo_num"
).split()


def _case_table(cases: str, true_dates: bool, from_cases: bool) -> dict[str, str]:
    s = f"_{cases}"
    own = {f"curr_{c}": _now(f"m.curr_{c}", f"m.bl_trig_{c}") for c in _RESOLVED}
    own |= {
        "curr_margin": "coalesce(m.curr_margin, m.bl_trig_margin)",
        "curr_margin_perc": "coalesce(m.curr_margin_perc, m.bl_trig_margin_perc)",
        "bl_mfg_cont_change": (
            "case when m.mmr_type in ('CCI', 'CCI/LM') then 'CONTRACT -> ACQUISITION' else m.bl_mfg_cont_change end"
        ),
        "cost_impact": f"(({_now('m.curr_cost', 'm.bl_trig_cost')}) - m.bl_cost) * m.curr_qty * 4",
        "var_cst_opp": "m.curr_comp_cost - m.curr_min_var_cst",
        "st_cnctd": (
            f"case when p.var_mck_cont_id = ({_now('m.curr_mck_cont', 'm.bl_trig_mck_cont')}) then 'Y' else 'N' end"
        ),
        "actl_neg_m": "t.neg_sls_3_mth - t.neg_cst_3_mth",
        "proj_neg_m": "(t.neg_sls_3_mth - t.neg_cst_3_mth) * 4",
        "actl_sls": "t.sls_3_mth",
        "proj_sls": "t.sls_3_mth * 4",
        "actl_gp": "t.sls_3_mth - t.cst_3_mth",
        "proj_gp": "(t.sls_3_mth - t.cst_3_mth) * 4",
    }
    sources = {
        "p": """bid_or_prca bid_or_prca_name lpg_id lpg_desc price_source_pcca mn_lpg_prca_cost var_cst_cont
            var_cst_cont_name var_cst_cont_type prcnt_cnctd pcca_cnctd""",
        "k": "cot",
        "a": "address addrss_line1 addrss_line2 addrss_line3 addrss_line4 city state zip",
        "f": """vrcst_mfg_cont vrcst_mck_cont vrcst_cont_atr_elig_flg vrcst_cont_tier_base_flg vrcst_orgn_scr
            vrcst_gpo_name bl_mck_cont curr_mck_cont bl_cont_atr_elig_flg bl_cont_tier_base_flg
            curr_cont_atr_elig_flg curr_cont_tier_base_flg curr_orgn_scr trig_cont_atr_elig_flg
            trig_cont_tier_base_flg""",
        "e": "vrcst_cont_excld",
        "g": """hin dea dea_exp_date prmry_gpo_flag prmry_gpo_num prmry_gpo_name prmry_gpo_id gpo_mmbrshp_st
            prmry_aff_st rx_gpo_num rx_gpo_name rx_gpo_id gpo_cot gpo_cot_name""",
        "n": "pool_name",
        "c" if from_cases else "p ": "team_assigned pool_num mmr_case insrt_dt case_cntr",
    }
    where = {name: alias.strip() for alias, names in sources.items() for name in names.split()}
    columns = [*HISTORY_COLUMNS, *(HISTORY_EXTRA_COLUMNS if from_cases else [])]
    items = ", ".join(f"{own.get(c) or where.get(c, 'm') + '.' + c} as {c}" for c in columns)
    return {
        f"accounts{s}": f"""
            select distinct m.ship_to from v_status m join {cases} c on c.acct_item_key = m.acct_item_key""",
        f"attributes{s}": _contract_attributes(f"price_lines{s}", cases),
        f"members{s}": _memberships(f"accounts{s}", true_dates),
        f"addresses{s}": _addresses(f"price_lines{s}"),
        f"trade{s}": f"""
            select distinct mms_sub_class_dsc as cot, cust_e1_num
            from v_customer_blend join accounts{s} on ship_to = cust_e1_num""",
        f"excluded{s}": FRAGMENTS["exclusion_flag"].replace("catalog_pairs", f"price_lines{s}"),
        f"case_table{s}": f"""
            select distinct {items} from v_status m
            join (select *, strftime({_D}, '%y%m%d') || case_prefix || case_cntr as mmr_case, {_D} as insrt_dt
                from {cases}) c on c.acct_item_key = m.acct_item_key
            join sales t on t.acct_item_key = c.acct_item_key
            left join trade{s} k on k.cust_e1_num = m.ship_to
            left join price_lines{s} p on p.acct_item_key = m.acct_item_key
            left join pools n on n.pool_num = c.pool_num and n.acct_or_bill_to = m.acct_or_bill_to
            left join members{s} g on g.ship_to = m.ship_to
            left join attributes{s} f on f.acct_item_key = m.acct_item_key
            left join excluded{s} e
                on e.dim_cust_curr_id = p.dim_cust_curr_id and e.vrcst_cntrct_tier_id = p.vrcst_cntrct_tier_id
            left join addresses{s} a on a.bus_pltfrm = m.bus_pltfrm and a.cust_key = m.ship_to""",
    }


FRAGMENTS |= _price_lines("cases") | _price_lines("cases_all") | _price_lines_v2("cases_all")
FRAGMENTS |= _case_table("cases", False, False) | _case_table("cases_all", True, True)
FRAGMENTS |= {
    "all_accounts": "select distinct ship_to from v_status",
    "contract_attributes": _contract_attributes("catalog_pairs", "v_status"),
    "gpo_membership": _memberships("all_accounts", False),
    "gpo_membership_true_dates": _memberships("all_accounts", True),
    "resolve_address": _addresses("v_ipc"),
    "class_of_trade": """
        select distinct mms_sub_class_dsc as cot, cust_e1_num from v_customer_blend
        where cust_e1_num in (select ship_to from v_status)""",
}

# ---- exceptions --------------------------------------------------------------------
_FOCUS = 4002
FRAGMENTS |= {
    "gpo_contracts": f"""
        select distinct concat(t.cntrct_num, '-', t.tier_num) as cont_num_tier
        from v_gpo g join v_contract_tier t on t.dim_gpo_id = g.dim_gpo_id
        where g.gpo_num = {_FOCUS} and g.gpo_end_dt > {_D} and t.cntrct_end_dt > {_D} and t.cntrct_type_cd = 'GPO'""",
    "gpo_items": f"""
        select distinct i.item_e1_num
        from v_gpo g join v_contract_tier t on t.dim_gpo_id = g.dim_gpo_id
        join v_contract_item c on c.dim_cntrct_tier_id = t.dim_cntrct_tier_id
        join v_item i on i.dim_item_e1_curr_id = c.dim_item_e1_curr_id
        where g.gpo_num = {_FOCUS} and g.gpo_end_dt > {_D} and t.cntrct_end_dt > {_D} and t.cntrct_type_cd = 'GPO'
            and c.end_dt > {_D} and i.item_e1_num in (select item_e1_num from v_ipc)""",
    "exception_base": f"""
        select case i.sys_pltfrm when 'AS400' then concat(i.acct_or_bill_to, '(1)', i.item_as400_num)
                when 'E1' then concat(i.ship_to, '(2)', i.item_e1_num) end as acct_item_key,
            i.sys_pltfrm, i.price_source, i.ship_to,
            {_rounded('cast(100 * (i.unit_price - i.comp_cost) as bigint)', 'cast(100 * i.unit_price as bigint)', 4)}
                as loaded_gp_perc,
            i.comp_cost_initial, i.vendor_name, d.parnt_suplr_num, i.prvt_brnd_flg, d.prod_grp_cd, i.comp_cost_cont_id,
            i.comp_cost_cont_type, h1.hierarchy as comp_cost_cont_hrchy, i.gpo_number, i.gpo_name,
            i.cust_primary_gpo_number, i.cust_primary_gpo_name, i.qty_3_mth, r.prmry_affln_gpo_cost_flg,
            r.singl_gso_rstrctn_flg, case when fi.item_e1_num is null then 'N' else 'Y' end as hpg_item,
            case when fc.cont_num_tier is null then 'N' else 'Y' end as var_cst_hpg_cont, c.mn_lpg_prca_cost,
            c.var_cst_cont, c.var_cst_cont_id, h2.hierarchy as var_cst_cont_hrchy, c.var_cst_cont_type,
            c.var_cst_gpo_num, c.var_cst_gpo_name, c.parnt_suplr_num as var_cst_parnt_suplr_num
        from v_ipc i
        left join v_item d on d.item_e1_num = i.item_e1_num
        left join v_customer_restriction r on r.cust_e1_num = i.ship_to
        left join gpo_items fi on fi.item_e1_num = i.item_e1_num
        left join (select distinct * exclude (var_cst_cont_name) from cheapest_all) c on c.prc_src_item_key = concat(i.price_source, ',',
            case when i.sys_pltfrm = 'E1' then cast(i.item_e1_num as varchar) else i.item_as400_num end)
        left join gpo_contracts fc on fc.cont_num_tier = c.var_cst_cont_id
        left join v_hierarchy h1 on h1.man_con_id = i.comp_cost_cont_id and h1.mck_con_id = {_before('i.comp_cost_list_id')}
        left join v_hierarchy h2 on h2.man_con_id = c.var_cst_cont and h2.mck_con_id = {_before('c.var_cst_cont_id')}
        where i.var_cost = 'Y'""",
}


def _category_rules() -> list[tuple[str, str]]:
    """Conditions and categories, in order."""
    e1, low, now = "sys_pltfrm = 'E1'", "var_cst_cont_type", "comp_cost_cont_type"
    other = "cust_primary_gpo_number <> var_cst_gpo_num"
    own = "gpo_number = cust_primary_gpo_number and gpo_number > 0"
    amr = "ship_to in (0, 4, 8, 12, 16, 20, 24, 28)"
    single, primary = f"{e1} and singl_gso_rstrctn_flg = 'Y'", f"{e1} and prmry_affln_gpo_cost_flg = 'Y'"
    brand = f"{e1} and prvt_brnd_flg = 'Y' and var_cst_cont = 'MCKB-NEG-LD'"
    listed = "parnt_suplr_num in (1, 2, 3)"
    ranked = "parnt_suplr_num = 5 and comp_cost_cont_hrchy is null and var_cst_parnt_suplr_num = 5"
    rules = [
        (f"{e1} and {low} = 'MKT'", "Market Contract"),
        (f"{amr} and prod_grp_cd = 'RX' and (var_cst_gpo_num not in (4001, 4003) or var_cst_gpo_name not like '%ASIA%')", "AMR"),
        (f"{amr} and prod_grp_cd <> 'RX' and {low} <> 'LOC'", "AMR"),
        (f"{single} and {now} = 'LOC' and {low} = 'MKT'", "Single GPO Flag"),
        (f"{single} and {now} = 'GPO' and {low} = 'MKT' and {own}", "Single GPO Flag"),
        (f"{single} and {now} = 'LOC' and {low} = 'GPO' and {other}", "Single GPO Flag"),
        (f"{single} and {now} = 'GPO' and {low} = 'GPO' and {own} and {other}", "Single GPO Flag"),
        (f"{e1} and cust_primary_gpo_number = {_FOCUS} and hpg_item = 'Y' and var_cst_hpg_cont = 'N' and {low} = 'GPO'",
         "HPG - Single Source"),
        (f"{primary} and {now} = 'LOC' and {low} = 'MKT'", "Primary GPO Flag"),
        (f"{primary} and {now} = 'GPO' and {low} = 'MKT' and {own}", "Primary GPO Flag"),
        (f"{primary} and {now} = 'MKT' and {low} = 'GPO' and {other}", "Primary GPO Flag"),
        (f"{brand} and loaded_gp_perc < 0.1", "Mck Brand < 10%"),
        (f"{brand} and loaded_gp_perc >= 0.1", "Mck Brand >= 10%"),
        ("var_cst_cont like '%RXLVC%' or var_cst_cont like '%OS980-LOCAL%'", "RX LVC/OS980 LOCAL"),
        ("var_cst_cont like '%OS980-%' and comp_cost_cont_id like '%OS980-%'", "OS980 GPO-GPO"),
        ("var_cst_cont like '%OS980-%' and comp_cost_cont_id not like '%OS980-%'", "OS980"),
        (f"{listed} and {now} in ('LOC', 'GPO') and {low} = 'MKT'", "Contract Hierarchy"),
        (f"{listed} and {now} = 'LOC' and {low} = 'GPO'", "Contract Hierarchy"),
        (f"parnt_suplr_num = 4 and {now} = 'GPO' and {low} = 'LOC'", "Contract Hierarchy"),
        (f"{ranked} and {now} = 'LOC' and {low} in ('GPO', 'MKT')", "BBraun Hierarchy"),
        (f"{ranked} and {now} = 'GPO' and {low} = 'MKT'", "BBraun Hierarchy"),
    ]
    for n in (1, 2):
        at = f"comp_cost_cont_hrchy = {n}"
        rules += [
            (f"{at} and {now} = 'LOC' and (var_cst_cont_hrchy > {n} or {low} in ('GPO', 'MKT'))", "BBraun Hierarchy"),
            (f"{at} and {now} = 'GPO' and (var_cst_cont_hrchy > {n} or {low} = 'MKT')", "BBraun Hierarchy"),
            (f"{at} and {now} = 'MKT' and var_cst_cont_hrchy > {n}", "BBraun Hierarchy"),
        ]
    third = "comp_cost_cont_hrchy = 3 and var_cst_parnt_suplr_num = 5"
    rules += [
        (f"{third} and {now} = 'LOC' and {low} in ('GPO', 'MKT')", "BBraun Hierarchy"),
        (f"{third} and {now} = 'GPO' and {low} = 'MKT'", "BBraun Hierarchy"),
        (f"parnt_suplr_num in (6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17) and {low} = 'GPO' and {other}", "Supplier Single Source"),
    ]
    return rules


def _category_case() -> str:
    return "case " + " ".join(f"when {c} then '{k}'" for c, k in _category_rules()) + " end"


def _rule_shadows() -> str:
    """Per rule the lines it matches, and those whose first match it is."""
    rules = _category_rules()
    flags = ", ".join(f"coalesce({c}, false) as r{i}" for i, (c, _) in enumerate(rules, 1))
    first = "case " + " ".join(f"when r{i} then {i}" for i in range(1, len(rules) + 1)) + " end"
    parts = [
        f"select {i} as rule, '{k}' as category, count(*) filter (r{i}) as n_matched, "
        f"count(*) filter (first_rule = {i}) as n_decided from (select *, {first} as first_rule from (select {flags} from exception_base))"
        for i, (_, k) in enumerate(rules, 1)
    ]
    return "select *, n_matched - n_decided as n_shadowed from (" + " union all ".join(parts) + ")"


FRAGMENTS |= {
    "rule_shadows": _rule_shadows(),
    "categorise": f"""
        select distinct acct_item_key, comp_cost_initial, mn_lpg_prca_cost, qty_3_mth, {_category_case()} as var_cst_ctgry
        from exception_base""",
    "category_opportunity": """
        select acct_item_key, var_cst_ctgry,
            case when var_cst_ctgry in ('Mck Brand < 10%', 'RX LVC/OS980 LOCAL', 'OS980')
                then (comp_cost_initial - mn_lpg_prca_cost) * qty_3_mth * 4 else 0 end as var_cst_opp
        from categorise where var_cst_ctgry is not null""",
    "category_totals": """
        select count(var_cst_ctgry) as n_categorised, sum((comp_cost_initial - mn_lpg_prca_cost) * qty_3_mth * 4) as total_gap
        from categorise""",
    # ---- reports -------------------------------------------------------------------
    "latest_run_cases": f"""
        select distinct case_cntr, mmr_case, team_assigned,
            case when team_assigned = 'STRAT' then {_text('pool_num', "'_'", 'pool_name', "'_GAP_REPORT_'", 'mmr_case')}
                else {_text('team_assigned', "'-'", 'mmr_case')} end as file_name
        from v_history_wide where insrt_dt = (select max(insrt_dt) from v_history_wide)""",
    "latest_snapshot": """
        select *, curr_comp_cost * (1 + bl_margin_perc) as new_sgstd_prc from v_history_runs
        qualify insrt_dt = max(insrt_dt) over (partition by acct_item_key)""",
    "report_rows": """
        select *, case when case_cntr > 70 then 'ITEM' else 'CONTRACT' end as incrs_type from v_history_wide""",
    "sales_measures": """
        select acct_item_key, neg_sls_3_mth - neg_cst_3_mth as actl_neg_m, (neg_sls_3_mth - neg_cst_3_mth) * 4 as proj_neg_m,
            sls_3_mth as actl_sls, sls_3_mth * 4 as proj_sls, sls_3_mth - cst_3_mth as actl_gp,
            (sls_3_mth - cst_3_mth) * 4 as proj_gp from v_weekly_txn""",
    "variable_cost_gap": "select acct_item_key, curr_comp_cost - curr_min_var_cst as var_cst_opp from v_status",
    "annualised_impact": f"""
        select acct_item_key, (({_now('curr_cost')}) - bl_cost) * curr_qty * 4 as cost_impact from v_status""",
    "resolve_margin": """
        select acct_item_key, coalesce(curr_margin, bl_trig_margin) as curr_margin,
            coalesce(curr_margin_perc, bl_trig_margin_perc) as curr_margin_perc from v_status""",
}
_CURRENT = [*_RESOLVED, "mck_cont", "cntrct_tier_id"]
FRAGMENTS["resolve_current"] = (
    "select acct_item_key, " + ", ".join(f"{_now('curr_' + c)} as curr_{c}" for c in _CURRENT) + " from v_status"
)

_DECIMALS = {
    c
    for table in [*INPUTS.values(), HISTORY_COLUMNS]
    for c, kind in table.items()
    if kind.startswith("decimal")
} - {"prcnt_cnctd"}
_DECIMALS |= {"sum_opp", "lpg_prca_cost", "strict_least", "new_sgstd_prc", "total_gap"}
_DECIMALS |= {f"sum_{c}" for c in "actl_neg_m proj_neg_m actl_gp proj_gp pndg_mmr_opp res_mmr_opp".split()}
_WHOLE = {
    c for table in [*INPUTS.values(), HISTORY_COLUMNS, HISTORY_EXTRA_COLUMNS] for c, kind in table.items() if kind == "bigint"
} | {"n_categorised", "rule", "n_matched", "n_decided", "n_shadowed", "n_rows", "n_out_of_order", "n_files", "n_left", "var_mck_cont_id", "var_mck_cont_tier"}


def _item(column: str) -> str:
    """Plain output type: decimals as double, whole numbers as bigint."""
    if column in _DECIMALS:
        return f"cast(cast({column} as decimal(28, 4)) as double) as {column}"
    if column == "prcnt_cnctd":
        return f"cast({column} as double) as {column}"
    return f"cast({column} as bigint) as {column}" if column in _WHOLE else column


def _chain(sql: str) -> str:
    """Fragments and views a statement needs, as a WITH clause in order."""
    done: list[str] = []

    def need(text: str) -> None:
        for word in re.findall(r"\b\w+\b", text):
            if word in done:
                continue
            if word in FRAGMENTS:
                # A column may carry a fragment's name; only sources count.
                if not re.search(rf"\b(?:from|join)\s+{word}\b", text):
                    continue
                need(FRAGMENTS[word])
                if word not in done:
                    done.append(word)
            elif word.startswith("v_") and word[2:] in _VIEWS:
                done.append(word)

    need(sql)
    parts = [f"{w} as ({duck_view(w[2:]) if w.startswith('v_') else FRAGMENTS[w].strip()})" for w in done]
    return f"with {', '.join(parts)} {sql}"


def statement(fragment: str, columns: list[str], where: str | None = None, distinct: bool = False) -> str:
    """Full SQL: the fragment's columns in plain types."""
    items = ", ".join(_item(c) for c in columns)
    condition = f" where {where}" if where else ""
    return _chain(f"select {'distinct ' if distinct else ''}{items} from {fragment}{condition}")


def summary_statement(dimensions: list[str], sums: list[str], team: str, cases: str) -> str:
    """Grouped report over the wide history."""
    keys = ", ".join(dimensions)
    aggregates = ", ".join(
        f"cast(cast(sum({c}) as decimal(28, 4)) as double) as sum_{c}" for c in sums
    )
    items = ", ".join(_item(c) for c in dimensions)
    average = "round(cast(sum(cast(prcnt_cnctd * 100 as bigint)) as double) / (100 * nullif(count(prcnt_cnctd), 0)), 6)"
    return _chain(
        f"select {items}, {average} as avg_prcnt_cnctd, {aggregates} from report_rows "
        f"where team_assigned = '{team}' and {cases} and mmr_type = 'VC' and insrt_dt > {_D} - 14 "
        f"and mn_lpg_prca_cost is not null group by {keys}"
    )
