"""Queries over the column library."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classes as cl, fixed_values as fv, numbers as nu, text as tx
from .registry import query

_INN_SQL = """case when length(d) in (10, 12) then d when length(d) in (9, 11) then '0' || d end"""


@query("digits_only", "select n_cmp, nullif(regexp_replace(c_inn, '[^0-9]', '', 'g'), '') as inn from companies")
def _(t):
    return t.companies.select("n_cmp", tx.digits_only("c_inn").alias("inn"))


@query("norm_inn", f"""
select n_cmp, {_INN_SQL} as inn from (
  select n_cmp, regexp_replace(regexp_replace(trim(c_inn || '.0'), '\\.0$', ''), '[^0-9]', '', 'g') as d from companies) x""")
def _(t):
    return t.companies.select("n_cmp", tx.norm_inn(F.concat("c_inn", F.lit(".0"))).alias("inn"))


@query("norm_agr", """
select n_agr, case when position('.0' in abs_agr_id) > 0 then cast(cast(abs_agr_id as decimal(38,1)) as bigint) || '' else abs_agr_id end as agr_id,
  case o_orderstatus when 'F' then cast(cast(floor(o_totalprice) as bigint) as varchar)
    when 'O' then nullif(replace(o_orderpriority, ' ', ''), '') else null end as agr_text
from agreements join orders on n_agr = cast(o_orderkey as varchar)""")
def _(t):
    raw = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.floor("o_totalprice").cast("string"), F.lit(",00"))).when(
        F.col("o_orderstatus") == "O", F.col("o_orderpriority")
    ).otherwise(F.lit(" nan "))
    cleaned = tx.norm_agr(raw)
    rows = t.agreements.join(t.orders, F.col("n_agr") == F.col("o_orderkey").cast("string"))
    return rows.select("n_agr", tx.norm_agr("abs_agr_id").alias("agr_id"), cleaned.alias("agr_text"))


@query("contract_keys", """
select n_agr, trim(c_agr_number) as contract, k as contract_key, nullif(regexp_replace(k, '^ЭД', ''), '') as contract_key_np
from (select n_agr, c_agr_number, nullif(regexp_replace(regexp_replace(replace(upper(c_agr_number), 'Ё', 'Е'), '[^A-ZА-Я0-9]+', '', 'g'),
  '^(ЕЭД|ЭДЭ|ВД|ЭД)', 'ЭД'), '') as k from agreements) x""")
def _(t):
    return t.agreements.select(
        "n_agr", tx.norm_contract("c_agr_number").alias("contract"), tx.contract_key("c_agr_number").alias("contract_key"),
        tx.contract_key_no_prefix("c_agr_number").alias("contract_key_np"),
    )


@query("clean_text", """
select doc_id, nullif(trim(regexp_replace(text, '[\\s ]+', ' ', 'g')), '') as cleaned from documents""")
def _(t):
    return t.documents.select("doc_id", tx.clean_text("text").alias("cleaned"))


@query("parse_num", """
select o_orderkey, case o_orderkey % 4 when 0 then null when 1 then o_totalprice when 2 then -o_totalprice else floor(o_totalprice) end as amount from orders""")
def _(t):
    spaced = F.regexp_replace(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), r"(\d)(\d{3})\.", "$1 $2,")
    mixed = (
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(spaced, F.lit(" n/a")))
        .when(F.col("o_orderkey") % 4 == 1, spaced)
        .when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("-"), spaced))
        .otherwise(F.floor("o_totalprice").cast("string"))
    )
    return t.orders.select("o_orderkey", nu.parse_num(mixed).alias("amount"))


@query("text_num", """
select report_month, agr_id, cast(coalesce(try_cast(nullif(trim(fin_result), '') as decimal(38,6)), 0) as double) as fin_result,
  cast(coalesce(try_cast(nullif(trim(chod), '') as decimal(38,6)), 0) as double) as chod from published""")
def _(t):
    return t.published.select("report_month", "agr_id", nu.text_num("fin_result").alias("fin_result"), nu.text_num("chod").alias("chod"))


@query("money2", """
select n_trx, cast(round_even(n_amt_tax, 2) as double) as half_even, cast(round(n_amt_tax, 2) as double) as half_up from trx_acq""")
def _(t):
    return t.trx_acq.select("n_trx", nu.money2("n_amt_tax").alias("half_even"), nu.money2("n_amt_tax", "half_up").alias("half_up"))


@query("blank_label", """
select report_month, agr_id, coalesce(nullif(nullif(trim(filial_rf), ''), '<NULL>'), 'Нет информации') as filial_filter,
  coalesce(nullif(nullif(trim(ssp_ocrm), ''), '<NULL>'), 'Нет данных') as ssp_ocrm_filter from published""")
def _(t):
    return t.published.select(
        "report_month", "agr_id", tx.blank_label("filial_rf", fv.NO_BRANCH_LABEL).alias("filial_filter"),
        tx.blank_label("ssp_ocrm", fv.NO_ZONE_LABEL).alias("ssp_ocrm_filter"),
    )


@query("month_key", """
select o_orderkey, strftime(o_orderdate, '%Y-%m') as month_text, year(o_orderdate) * 100 + month(o_orderdate) as month_number from orders""")
def _(t):
    return t.orders.select("o_orderkey", nu.month_key("o_orderdate").alias("month_text"), nu.month_int("o_orderdate").alias("month_number"))


@query("norm_branch", """
select c_custkey, case when s = '' then null else replace(upper(substr(s, 1, 1)) || substr(s, 2), 'рф', 'РФ') end as branch
from (select c_custkey, trim(regexp_replace(regexp_replace(b, '^(.*?рф).*$', '\\1'), '(^|\\s)(ао|пао|оао|зао)(\\s.*)?$', ''), ' ,;.-') as s
  from (select c_custkey, lower(trim(regexp_replace(case when c_nationkey < 8 then ' ' || c_mktsegment || '  РФ банк'
      when c_nationkey < 16 then c_mktsegment || ', ПАО Банк' when c_nationkey < 20 then 'ЗАО' else c_name end, '\\s+', ' ', 'g'))) as b from customer) x) y""")
def _(t):
    raw = (
        F.when(F.col("c_nationkey") < 8, F.concat(F.lit(" "), "c_mktsegment", F.lit("  РФ банк")))
        .when(F.col("c_nationkey") < 16, F.concat("c_mktsegment", F.lit(", ПАО Банк")))
        .when(F.col("c_nationkey") < 20, "ЗАО")
        .otherwise(F.col("c_name"))
    )
    return t.customer.select("c_custkey", tx.norm_branch(raw).alias("branch"))


@query("zone_class", """
select row_id, case when z like 'дкб%' then 'ДКБ' when z like 'дмсб(ми%' or z like 'дммб%' then 'ДМ'
  when z like 'дмсб%' or z like 'дсб%' then 'ДМСБ' when z like 'дм%' then 'ДМ' end as zone
from (select row_id, replace(lower(x_area_resp), ' ', '') as z from master) x""")
def _(t):
    return t.master.select("row_id", cl.zone_class("x_area_resp").alias("zone"))


_TARIFF = """case when t like '%акт%' then 'По актам' when t like '%акцион%' or t like '%меню%' or t like '%сезон%' then 'Акционный'
  when t like '%индив%'{zero} then 'Индивидуальный' when t like '%стандарт%' then 'Стандарт' else 'Не сегментирован' end"""


@query("tariff_class", f"""
select id, {_TARIFF.format(zero="")} as lake_class, {_TARIFF.format(zero=" or trim(t) in ('0', '0.0', '0.00')")} as excel_class
from (select id, lower(coalesce(c_name, '')) as t from tariff_plan) x""")
def _(t):
    return t.tariff_plan.select("id", cl.tariff_class("c_name").alias("lake_class"), cl.tariff_class("c_name", "excel").alias("excel_class"))


@query("tariff_group", """
select id, case when regexp_full_match(trim(c_name), '0(\\.0+)?') then '0'
  when t like '%акт%' and (t like '%индивид%' or t like '%по акту%' or t like 'по акт%') then 'По Акту индивидуальный'
  when t like '%меню%' or t like '%возможност%' then 'Меню возможностей' when t like '%стандарт%' then 'Стандарт' end as tariff_group
from (select id, c_name, replace(lower(trim(c_name)), 'ё', 'е') as t from tariff_plan) x""")
def _(t):
    return t.tariff_plan.select("id", cl.tariff_group("c_name").alias("tariff_group"))


@query("prefix_group", """
select event_id, case when c like 'CLICK%' then 'CLICK' when c in ('VIEW', 'VIEW1') then 'VIEW' when c like 'P%' then 'P' end as code_group
from (select event_id, upper(replace(trim(event_type), ' ', '')) as c from events) x""")
def _(t):
    return t.events.select("event_id", cl.prefix_group("event_type", ["CLICK", "VIEW", "P"], {"VIEW": ["VIEW", "VIEW1"]}).alias("code_group"))


@query("semantic_text_key", """
select doc_id, regexp_replace(s, '[^0-9a-zа-я]+', '', 'g') as key from (
  select doc_id, case when position('copyright' in n) > 0 then trim(split_part(n, 'copyright', 1) || 'copyright', ' ,;:-') else n end as s
  from (select doc_id, trim(regexp_replace(replace(lower(coalesce(text, '')), 'ё', 'е'), '[\\s   ]+', ' ', 'g')) as n from documents) x) y""")
def _(t):
    return t.documents.select("doc_id", tx.semantic_text_key("text", "copyright").alias("key"))


@query("safe_pct", """
select o_orderkey, case when d <> 0 then abs(cast(o_totalprice - d as double)) / abs(d) * 100.0 end as divergence_pct
from (select o_orderkey, o_totalprice, case when o_orderpriority = '5-LOW' then 0.0 when o_orderpriority = '2-HIGH' then null
  else cast(o_custkey as double) end as d from orders) x""")
def _(t):
    ref = F.when(F.col("o_orderpriority") == "5-LOW", 0.0).when(F.col("o_orderpriority") != "2-HIGH", F.col("o_custkey").cast("double"))
    return t.orders.withColumn("d", ref).select("o_orderkey", nu.safe_pct(F.col("o_totalprice") - F.col("d"), "d").alias("divergence_pct"))


@query("months_between_cal", """
select n_agr, date_diff('month', d_valid_from, d_valid_to) as months, case when d_valid_to is null then 'null'
  when date_diff('month', d_valid_from, d_valid_to) - 20 < 0 then 'lt_0' when date_diff('month', d_valid_from, d_valid_to) - 20 < 12 then '0_11'
  when date_diff('month', d_valid_from, d_valid_to) - 20 < 24 then '12_23' when date_diff('month', d_valid_from, d_valid_to) - 20 < 36 then '24_35'
  when date_diff('month', d_valid_from, d_valid_to) - 20 < 48 then '36_47' else 'ge_48' end as age_bucket from agreements""")
def _(t):
    months = nu.months_between_cal("d_valid_from", "d_valid_to")
    return t.agreements.select("n_agr", months.alias("months"), cl.age_bucket(months - 20).alias("age_bucket"))


@query("sign_and_cohorts", """
select report_month, n_agr, case when chod > 0 then 'Клиенты с положительным ЧОД ТЭ' when chod < 0 then 'Клиенты с отрицательным ЧОД ТЭ'
  else 'Клиенты с 0 ЧОД ТЭ' end as client_bucket, case when chod > 0 and chod <= 2500 then 1 else 0 end as cohort_0_2500,
  case when chod > 2500 then 1 else 0 end as cohort_gt_2500, case when chod = 0 then 1 else 0 end as cohort_eq_0,
  case when chod < 0 then 1 else 0 end as cohort_lt_0 from mart""")
def _(t):
    flags = [c.alias(n) for n, c in cl.cohort_flags("chod").items()]
    return t.mart.select("report_month", "n_agr", cl.sign_bucket("chod").alias("client_bucket"), *flags)


_LABELS = ", ".join(f"case when {f} = '1' then '{label}' end" for f, label in fv.PRODUCT_LABELS.items())
_MISSING = ", ".join(f"case when coalesce({f}, '0') <> '1' then '{fv.PRODUCT_LABELS[f]}' end" for f in fv.RECOMMENDABLE)


@query("label_lists", f"""
select report_month, agr_id, inn, trx_sum, concat_ws(', ', {_LABELS}) as products, concat_ws(', ', {_MISSING}) as missing from published""")
def _(t):
    flags = t.published.withColumns({f: nu.text_num(f, "int") for f in fv.PRODUCT_FLAGS})
    return flags.select("report_month", "agr_id", "inn", "trx_sum", cl.label_list().alias("products"), cl.missing_label_list().alias("missing"))


@query("coalesce_by_source", """
select n_agr, coalesce(nullif(trim(abs_agr_id), ''), n_cmp_client) as agr_id,
  case when nullif(trim(abs_agr_id), '') is not null then 'sa' when n_cmp_client is not null then 'company' else 'none' end as agr_id_source from agreements""")
def _(t):
    value, source = nu.coalesce_by_source(["abs_agr_id", "n_cmp_client"], ["sa", "company"], "none", tx.blank_to_null)
    return t.agreements.select("n_agr", value.alias("agr_id"), source.alias("agr_id_source"))


@query("fill_from_fallbacks", """
select report_month, agr_id, trx_sum, coalesce(case when trim(filial_rf) not in ('', 'nan', 'None', '<NULL>') then trim(filial_rf) end,
  case when trim(ssp_ocrm) not in ('', 'nan', 'None', '<NULL>') then trim(ssp_ocrm) end,
  case when trim(tariff_short) not in ('', 'nan', 'None', '<NULL>') then trim(tariff_short) end) as filled from published""")
def _(t):
    return t.published.select("report_month", "agr_id", "trx_sum", nu.fill_from_fallbacks("filial_rf", "ssp_ocrm", "tariff_short").alias("filled"))


@query("bounded_counts", """
select report_month, n_agr, least(greatest(coalesce(active_terms - 1, 0), 0), coalesce(retl_cnt, 0)) as bounded,
  greatest(retl_cnt - active_terms * 2, 0) as passive from mart""")
def _(t):
    return t.mart.select(
        "report_month", "n_agr", nu.bounded_count(F.col("active_terms") - 1, "retl_cnt").alias("bounded"),
        nu.passive_terms("retl_cnt", F.col("active_terms") * 2).alias("passive"),
    )


@query("drop_bad_rows", """
select report_month, agr_id, active_terms, fin_result from published
where nullif(trim(agr_id), '') is not null or nullif(trim(active_terms), '') is not null or nullif(trim(fin_result), '') is not null""")
def _(t):
    return nu.drop_bad_rows(t.published, ["agr_id", "active_terms", "fin_result"]).select("report_month", "agr_id", "active_terms", "fin_result")


@query("profit_formulas", """
select report_month, n_agr, cast(commission_from_ops + commission_monthly as double) as commission_total, cast(retl_cnt * 1926 as bigint) as aur,
  cast(commission_from_ops + commission_monthly + int_component as double) as chod,
  cast(commission_from_ops + commission_monthly + int_component - retl_cnt * 1926 - amortization as double) as fin_result from facts""")
def _(t):
    return nu.profit_formulas(t.facts).select("report_month", "n_agr", "commission_total", "aur", "chod", "fin_result")


@query("marker_tag", """
select doc_id, case when regexp_matches(lower(text), '@') and regexp_matches(lower(text), 'http') then 'contact and link'
  when regexp_matches(lower(text), '@') then 'contact' when regexp_matches(lower(text), '[0-9]{3}') then 'digits' else 'plain' end as tag from documents""")
def _(t):
    rules = [(("@", "http"), "contact and link"), (("@",), "contact"), (("[0-9]{3}",), "digits")]
    return t.documents.select("doc_id", tx.marker_tag(F.lower("text"), rules, "plain").alias("tag"))


@query("ratio_bucket", """
select bucket, count(*) as rows from (select case when r is null then 'na' when abs(r - 2) < 0.05 then '2x' when abs(r - 3) < 0.05 then '3x'
  when abs(r - 4) < 0.05 then '4x' when abs(r - 5) < 0.05 then '5x' when abs(r - 6) < 0.05 then '6x' when abs(r - 8) < 0.05 then '8x'
  when abs(r - 10) < 0.05 then '10x' when r < 1 then '<1x' else 'other' end as bucket
  from (select case when l_discount <> 0 then l_tax / l_discount end as r from lineitem) x) y group by 1""")
def _(t):
    bucket = cl.ratio_bucket(nu.ratio("l_tax", "l_discount"))
    return t.lineitem.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
