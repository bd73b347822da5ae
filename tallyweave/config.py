"""Survey constants: field widths, code sets, regions and template columns."""

from __future__ import annotations

DOCUMENTED = "documented"
LITERAL = "literal"


def check_semantics(value: str) -> str:
    if value not in (DOCUMENTED, LITERAL):
        raise ValueError(f"semantics must be {DOCUMENTED!r} or {LITERAL!r}, got {value!r}")
    return value


# ---------------------------------------------------------------------------
# Field names and widths of the 38-character person ID.
ID_WIDTHS = {
    "NG": 2,
    "DP": 2,
    "DB": 3,
    "BP": 3,
    "BP2": 3,
    "CONVERTEDBP": 3,
    "ST": 1,
    "NOTK": 4,
    "NOIR": 2,
    "S": 1,
    "NP": 3,
    "PKIS": 2,
    "HMIS": 2,
    "J": 1,
    "KET": 4,
    "B": 2,
}

# Fields of the household response key.
RESPONSE_FIELDS = ["B", "NG", "DP", "DB", "BP", "BP2", "CONVERTEDBP", "ST", "NOTK", "NOIR", "S", "NP"]

# States by region.
PENINSULAR = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 14, 16]
SABAH = [12, 15]
SARAWAK = [13]

# Fixed value: citizenship code of citizens.
CITIZEN_CODE = 458

# Ethnic codes by family.
MALAY = [1100, 3210]
CHINESE = [*range(5110, 5201, 10), 5998]
INDIAN = [*range(6110, 6181, 10), 6998]
OTHERS = [
    *range(7110, 7231, 10), 7998,
    *range(8110, 8161, 10), 8998,
    *range(9110, 9151, 10), 9998,
]
OTHER_BUMIPUTERA = [
    *range(2111, 2117), *range(2121, 2127), *range(2131, 2137),
    *[code for code in range(3110, 3261, 10) if code != 3210], 3998,
    *range(4110, 4361, 10), 4998,
]


def _rest_of_bumiputera(*named: int) -> list[int]:
    return [code for code in OTHER_BUMIPUTERA if code not in named]


# Ethnic group number -> codes, per region.
GROUPS_PENINSULAR = {1: MALAY, 2: OTHER_BUMIPUTERA, 3: CHINESE, 4: INDIAN, 5: OTHERS}
GROUPS_SABAH = {
    1: MALAY,
    2: [3150, 3190],
    3: [3110],
    4: [3220],
    5: _rest_of_bumiputera(3150, 3190, 3110, 3220),
    6: CHINESE,
    7: INDIAN + OTHERS,
}
GROUPS_SARAWAK = {
    1: MALAY,
    2: [4140],
    3: [4110],
    4: [4260],
    5: _rest_of_bumiputera(4140, 4110, 4260),
    6: CHINESE,
    7: INDIAN + OTHERS,
}

# Population template column -> (group, region). Group 0 is the non-citizen cell.
POPULATION_COLUMNS = {
    "BPPD_MALAY": (1, "SEM"),
    "BPPD_OTHER_BUMI": (2, "SEM"),
    "BPPD_CHINESE": (3, "SEM"),
    "BPPD_INDIAN": (4, "SEM"),
    "BPPD_OTHERS": (5, "SEM"),
    "BPPD_BUKAN_WARGA": (0, "SEM"),
    "BPPD_SABAH_MELAYU": (1, "SAB"),
    "BPPD_SABAH_KADAZAN": (2, "SAB"),
    "BPPD_SABAH_BAJAU": (3, "SAB"),
    "BPPD_SABAH_MURUT": (4, "SAB"),
    "BPPD_SABAH_BUMIPUTERA LAIN": (5, "SAB"),
    "BPPD_SABAH_CINA": (6, "SAB"),
    "BPPD_SABAH_LAIN LAIN": (7, "SAB"),
    "BPPD_SABAH_BUKAN_WARGA": (0, "SAB"),
    "BPPD_SARAWAK_MELAYU": (1, "SAR"),
    "BPPD_SARAWAK_IBAN": (2, "SAR"),
    "BPPD_SARAWAK_BIDAYUH": (3, "SAR"),
    "BPPD_SARAWAK_MELANAU": (4, "SAR"),
    "BPPD_SARAWAK_BUMIPUTERA": (5, "SAR"),
    "BPPD_SARAWAK_CINA": (6, "SAR"),
    "BPPD_SARAWAK_LAIN_LAIN": (7, "SAR"),
    "BPPD_SARAWAK_BUKAN_WARGA": (0, "SAR"),
}

# Establishment code columns and their documented lengths.
CODE_WIDTHS = {
    "SUBSTATE_CODE": 2,
    "NEWSSID": 12,
    "MSIC2008_SMPL": 5,
    "MSIC2008": 5,
    "STATE_CODE": 2,
}
# Lengths the scripts use in place of the documented ones.
CODE_WIDTHS_LITERAL = {**CODE_WIDTHS, "MSIC2008_SMPL": 12, "MSIC2008": 12}

# Employment bands, lower bound -> stratum.
EMPLOYMENT_BANDS_C = [(201, None, 1), (75, 200, 2), (5, 74, 3)]
EMPLOYMENT_BANDS_OTHER = [(76, None, 1), (30, 75, 2), (5, 29, 3)]

# Derived totals and the variables that carry a category total.
PAY_PARTS, PAY_TOTAL = list("LMNOP"), "Q"
SEPARATION_PARTS, SEPARATION_TOTAL = list("DEF"), "X"
CATEGORY_VARIABLES = list("ABCDEFGHIJLMNOPQRX")

# Words that mean "missing" in delimited input.
NULL_WORDS = ["", "NaN", "nan", "-NaN", "-nan", "NA", "N/A", "n/a", "#N/A", "#NA", "NULL", "null", "None", "<NA>"]
