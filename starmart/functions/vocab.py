"""Fixed values that results depend on.

Every list here must equal the published domain values exactly (labels are
Portuguese because they are data, not UI text).  They are kept together, in
natural order, so they can be audited at a glance.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Regions of Brazil and their states.
# ---------------------------------------------------------------------------
REGIONS: dict[str, list[str]] = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
STATES: list[str] = sorted(uf for ufs in REGIONS.values() for uf in ufs)

# Fallback region labels, one per rule set / report.
NOT_INFORMED = "NÃO INFORMADO"          # SQL rule set
NOT_INFORMED_FRAME = "Não informado"     # frame rule set (region, direction)
NOT_IDENTIFIED = "Não identificado"      # yearly report label for unknown states
NOT_INFORMED_SPECIES_BLANK = "Não Informado"  # SQL rule set, blank species

# ---------------------------------------------------------------------------
# Terms that mean "not informed" (compared after trim + upper).
# ---------------------------------------------------------------------------
MISSING_TERMS: list[str] = ["'-1", "-1", "NA", "NAO INFORMADO", "NÃO ENCONTRADO", "NÃO INFORMADO"]
# Terms counted by the inspection of vehicle makes.
INSPECTED_TERMS: list[str] = ["-1", "NA", "NAO INFORMADO", "NÃO ENCONTRADO", "NÃO INFORMADO"]
# The SQL rule set also treats N/I as missing for species.
MISSING_TERMS_SPECIES_SQL: list[str] = MISSING_TERMS + ["N/I"]
# The SQL rule for make lists a mis-cased spelling that upper() never yields.
MISSING_TERMS_MAKE_SQL: list[str] = ["'-1", "-1", "NA", "NAO INFORMADO", "NÃO ENCONTRADO", "Não INFORMADO"]

# ---------------------------------------------------------------------------
# Vehicle species.
# ---------------------------------------------------------------------------
SPECIES_KEPT: list[str] = ["PASSAGEIRO", "CARGA", "ESPECIAL", "MISTO", "CORRIDA", "COMPETIÇÃO"]
SPECIES_ACCENT_FIX: dict[str, str] = {"TRACAO": "TRAÇÃO", "COLECAO": "COLEÇÃO", "COMPETICAO": "COMPETIÇÃO"}

# ---------------------------------------------------------------------------
# Foreign-vehicle flag.
# ---------------------------------------------------------------------------
FOREIGN_COUNTRIES: list[str] = ["AR", "BO", "CL", "GY", "MX", "PY", "UY", "VE"]
FOREIGN_YES: list[str] = ["S"] + FOREIGN_COUNTRIES
FOREIGN_NO: list[str] = ["N", "BR"]
NOT_IDENTIFIED_CODE = "N/I"
ABROAD_CODE = "EX"

# ---------------------------------------------------------------------------
# Plate-state junk codes.
# ---------------------------------------------------------------------------
PLATE_JUNK: list[str] = ["/", "-1", "'-1", ""]

# ---------------------------------------------------------------------------
# Document type and traffic direction.
# ---------------------------------------------------------------------------
DOC_TYPES: dict[str, str] = {
    "AI": "Auto de Infração",
    "AIT": "Auto de Infração de Trânsito",
    "ANI": "Aviso de Notificação de Infração",
}
DIRECTIONS: dict[str, str] = {"C": "Crescente", "D": "Decrescente"}

# ---------------------------------------------------------------------------
# Weekday names, Monday first (ISO day 1..7).
# ---------------------------------------------------------------------------
WEEKDAYS: list[str] = [
    "Segunda-feira",
    "Terça-feira",
    "Quarta-feira",
    "Quinta-feira",
    "Sexta-feira",
    "Sábado",
    "Domingo",
]

# ---------------------------------------------------------------------------
# National holidays.
# Fixed-date holidays as (month, day); movable ones listed per year.
# Movable days are Easter -47 (Carnival), -2 (Good Friday), 0 (Easter),
# +60 (Corpus Christi); the listed years match that rule.
# ---------------------------------------------------------------------------
FIXED_HOLIDAYS: list[tuple[int, int]] = [(1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)]
MOVABLE_HOLIDAYS: dict[int, list[str]] = {
    2022: ["2022-03-01", "2022-04-15", "2022-04-17", "2022-06-16"],
    2023: ["2023-02-21", "2023-04-07", "2023-04-09", "2023-06-08"],
    2024: ["2024-02-13", "2024-03-29", "2024-03-31", "2024-05-30"],
}
EASTER_OFFSETS: list[int] = [-47, -2, 0, 60]

# ---------------------------------------------------------------------------
# Report constants.
# ---------------------------------------------------------------------------
EXCESS_RANGE = (0, 150)        # sanity cut on excess speed, (low, high]
OUTLIER_EXCESS = 200           # outlier listing threshold
MIN_GROUP_ROWS = 100           # minimum group size in the vehicle profile
HOUR_RANGE = (0, 2359)         # valid hhmm values
REPORT_EXCLUDED_STATES: list[str] = ["N/I", "EX"]
REPORT_EXCLUDED_LABELS: list[str] = ["-1", "Não informado", "N/I", "NÃO INFORMADO"]
STACK_ORDER: list[str] = ["Norte", "Nordeste", "Centro-Oeste", "Sul", "Sudeste"]
REGION_COLOURS: dict[str, str] = {
    "Norte": "#2196F3",
    "Nordeste": "#FF9800",
    "Centro-Oeste": "#9C27B0",
    "Sudeste": "#F44336",
    "Sul": "#4CAF50",
}
FOREIGN_COLOURS: dict[str, str] = {"S": "#F44336", "N": "#2196F3"}
DEFAULT_COLOUR = "#888"
LABEL_PREFIX_CHARS = 45
