from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import classes as cl, fixed_values as fv, numbers as nu, text as tx


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize(
    "column, rows, expected",
    [
        (lambda: tx.norm_inn("v"), ["123456789", "12345678901", "1234567890.0", "12-34567890", "123", "", None, "0123456789"],
         ["0123456789", "012345678901", "1234567890", "1234567890", None, None, None, "0123456789"]),
        (lambda: tx.norm_agr("v"), ["00123", "123.0", "1 234,00", "1,5", "nan", "None", "", None, "A.0", "1E3"],
         ["123", "123", "1234", "1.5", None, None, None, None, "A", "1000"]),
        (lambda: tx.digits_only("v"), [" 1-2 3", "abc", None], ["123", None, None]),
        (lambda: tx.contract_key("v"), ["ЭДЭ 12/3", "вд-ё1", "ЕЭД7", " ", "9"], ["ЭД123", "ЭДЕ1", "ЭД7", None, "9"]),
        (lambda: tx.contract_key_no_prefix("v"), ["ЭДЭ 12/3", "ЭД"], ["123", None]),
        (lambda: tx.clean_text("v"), ["a \t b\r\nc ", " \n", None], ["a b c", None, None]),
        (lambda: tx.blank_to_null("v"), [" x ", "nan", "None", "<NULL>", "", None], ["x", None, None, None, None, None]),
        (lambda: tx.blank_label("v", "нет"), ["<NULL>", " ", None, "x"], ["нет", "нет", "нет", "x"]),
        (lambda: tx.norm_branch("v"), ["Московский  РФ АО Банк", "КУРСКИЙ, ПАО Банк", "АО Банк", " тверской.рф ", "Каонский", None],
         ["Московский РФ", "Курский", None, "Тверской.РФ", "Каонский", None]),
        (lambda: tx.semantic_text("v"), ["Оплата  по договору № 5", "Ёлка 1", None], ["оплата по договору", "елка 1", ""]),
        (lambda: tx.semantic_text_key("v"), ["Оплата, по договору № 5"], ["оплатаподоговору"]),
        (lambda: cl.zone_class("v"), ["ДКБ-1", "дмсб (ми", "ДММБ", "ДМСБ (ср)", "ДСБ", "ДМ 1", "x", None],
         ["ДКБ", "ДМ", "ДМ", "ДМСБ", "ДМСБ", "ДМ", None, None]),
        (lambda: cl.tariff_class("v"), ["По актам меню", "Сезон", "индив", "стандарт", "0", None],
         ["По актам", "Акционный", "Индивидуальный", "Стандарт", "Не сегментирован", "Не сегментирован"]),
        (lambda: cl.tariff_class("v", "excel"), ["0", "0,00", "1"], ["Индивидуальный", "Индивидуальный", "Не сегментирован"]),
        (lambda: cl.tariff_group("v"), ["0", "0.0", "По акту", "Меню", "акт", "стандарт", "", None],
         ["0", "0", "По Акту индивидуальный", "Меню возможностей", None, "Стандарт", None, None]),
        (lambda: cl.prefix_group("v", ["14", "26"], {"26": ["26.2У"]}), ["14.1", "26.2 y", "26.1", None], ["14", "26", None, None]),
        (lambda: nu.month_key("v"), ["2026-01-15", " 2026-02", ""], ["2026-01", "2026-02", None]),
        (lambda: nu.month_int("v"), ["2026-01", "202602", "x"], [202601, 202602, None]),
        (lambda: nu.parse_num("v"), ["1 234,5", "1 000", "nan", "x", None], [1234.5, 1000.0, None, None, None]),
    ],
)
def test_text_columns(spark, column, rows, expected):
    assert values(spark, column(), rows) == expected


def test_money_rounding(spark):
    rows = [Decimal("0.125"), Decimal("0.135"), Decimal("-0.125"), None]
    assert values(spark, nu.money2("v"), rows, "decimal(10,3)") == [Decimal("0.12"), Decimal("0.14"), Decimal("-0.12"), None]
    assert values(spark, nu.money2("v", "half_up"), rows, "decimal(10,3)") == [Decimal("0.13"), Decimal("0.14"), Decimal("-0.13"), None]


def test_numbers(spark):
    assert values(spark, nu.text_num("v").cast("double"), [" 1.5", "", None, "x"]) == [1.5, 0.0, 0.0, 0.0]
    assert values(spark, nu.safe_pct(F.lit(-5), "v"), [10.0, 0.0, None], "double") == [50.0, None, None]
    assert values(spark, cl.age_bucket("v"), [None, -1, 0, 12, 24, 36, 48], "int") == ["null", "lt_0", "0_11", "12_23", "24_35", "36_47", "ge_48"]
    assert values(spark, nu.bounded_count("v", F.lit(3)), [None, -1, 2, 9], "int") == [0, 0, 2, 3]
    assert values(spark, cl.sign_bucket("v"), [1.0, -1.0, 0.0, None], "double") == [fv.SIGN_LABELS[i] for i in (0, 1, 2, 2)]
    assert values(spark, cl.ratio_bucket("v"), [2.04, 0.5, 7.0, None], "double") == ["2x", "<1x", "other", "na"]


def test_formulas_treat_missing_as_zero(spark):
    df = spark.createDataFrame([(None, 10.0, 2, 1.0, 3.0)], "commission_from_ops double, commission_monthly double, retl_cnt int, int_component double, amortization double")
    row = nu.profit_formulas(df).first()
    assert (row.commission_total, row.aur, row.chod, row.fin_result) == (10.0, 3852, 11.0, 11.0 - 3852 - 3.0)
