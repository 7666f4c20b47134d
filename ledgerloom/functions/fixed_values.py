"""Word lists, labels, prefixes and constants.

They must equal the values the business rules prescribe; every function that
uses one takes it as a parameter with the value below as default.
"""

# Text spellings of "no value".
BLANKS = ("", "nan", "None", "<NULL>")

# Open end of a validity interval.
OPEN_END = "2999-12-31"

# Monthly upkeep cost of one outlet.
OUTLET_UNIT_COST = 1926

# Months over which a device is written off.
DEVICE_LIFE_MONTHS = 48

# Name prefix of outlets that only hold spare devices.
RESERVED_OUTLET_PREFIX = "REZERVNYI TERMINAL"

# Responsibility zones: first matching prefix wins (text lower-cased, no spaces).
ZONE_RULES = (
    ("дкб", "ДКБ"),
    ("дмсб(ми", "ДМ"),
    ("дммб", "ДМ"),
    ("дмсб", "ДМСБ"),
    ("дсб", "ДМСБ"),
    ("дм", "ДМ"),
)

# Tariff classes: first rule with any of its keywords wins.
TARIFF_RULES = (
    (("акт",), "По актам"),
    (("акцион", "меню", "сезон"), "Акционный"),
    (("индив",), "Индивидуальный"),
    (("стандарт",), "Стандарт"),
)
TARIFF_ZERO_LABEL = "Индивидуальный"
TARIFF_OTHER_LABEL = "Не сегментирован"

# Alternative tariff groups.
GROUP_ZERO = "0"
GROUP_ACT = "По Акту индивидуальный"
GROUP_MENU = "Меню возможностей"
GROUP_STANDARD = "Стандарт"

# Branch names: marker that ends a name, and legal forms that start its tail.
BRANCH_MARKER = "рф"
LEGAL_FORMS = ("ао", "пао", "оао", "зао")

# Contract number prefixes that mean the same, and their common spelling.
CONTRACT_PREFIXES = ("ЕЭД", "ЭДЭ", "ВД", "ЭД")
CONTRACT_PREFIX = "ЭД"

# Phrase after which a payment text carries only contract details.
TAIL_PHRASE = "по договору"

# Dashboard labels.
NO_BRANCH_LABEL = "Нет информации"
NO_ZONE_LABEL = "Нет данных"
SIGN_LABELS = (
    "Клиенты с положительным ЧОД ТЭ",
    "Клиенты с отрицательным ЧОД ТЭ",
    "Клиенты с 0 ЧОД ТЭ",
)
COHORT_LIMIT = 2500

# Product flag columns, their labels, and the subset worth recommending.
PRODUCT_LABELS = {
    "rko": "РКО",
    "accounting": "Бухгалтерия",
    "business_cards": "Бизнес-карта",
    "credit": "Кредиты",
    "dbo": "ДБО",
    "deposit": "Депозиты",
    "insurance": "Страхование",
    "loyalty_program": "Программа лояльности",
    "nmo": "МНО",
    "nso": "НСО",
    "pravocard": "Правокард",
    "salary_project": "Зарплатный проект",
    "self_inkass": "Самоинкассация",
    "service_package": "Сервис пэкэдж",
    "sms_info": "СМС-инфо",
}
PRODUCT_FLAGS = tuple(PRODUCT_LABELS)
EXCLUDED_PRODUCTS = ("acquiring",)
RECOMMENDABLE = (
    "rko",
    "business_cards",
    "dbo",
    "insurance",
    "pravocard",
    "salary_project",
    "self_inkass",
    "sms_info",
)

# Metrics compared between a mart and an independent report.
COMPARE_METRICS = (
    "unique_inn",
    "retl_cnt",
    "term_cnt",
    "trx_cnt",
    "trx_sum",
    "commission_from_ops",
    "commission_monthly",
    "commission_total",
    "int_component",
    "chod",
    "aur",
    "amortization",
    "fin_result",
)

#: Reasons of a match by name, by its status.
MATCH_REASONS = {
    "not_found": "Нет кандидатов по названию (name_sim<{})",
    "matched_by_name_high": "Высокое сходство имени (>={})",
    "ambiguous_multi_candidates": "Несколько кандидатов с близким score (>= {})",
    "ambiguous_low_confidence": "Матч только по имени, name_sim={}",
}
