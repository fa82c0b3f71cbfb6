"""Literals that the results depend on, kept together as plain text."""

# Spreadsheet error literals.
ERROR_LITERALS = ("#REF!", "#NAME?", "#VALUE!", "#DIV/0!", "#N/A", "#NUM!", "#NULL!")

# Marker of a measure that is not significant.
NOT_SIGNIFICANT = "NS"

# French month words, accents removed.
MONTH_NUMBERS = {
    "JANVIER": 1, "JAN": 1,
    "FEVRIER": 2, "FEV": 2,
    "MARS": 3, "MAR": 3,
    "AVRIL": 4, "AVR": 4,
    "MAI": 5,
    "JUIN": 6,
    "JUILLET": 7, "JUIL": 7,
    "AOUT": 8,
    "SEPTEMBRE": 9, "SEPT": 9,
    "OCTOBRE": 10, "OCT": 10,
    "NOVEMBRE": 11, "NOV": 11,
    "DECEMBRE": 12, "DEC": 12,
}

# French month names and abbreviations, January first.
MONTH_NAMES = (
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
)
MONTH_ABBREVIATIONS = (
    "janv", "févr", "mars", "avr", "mai", "juin",
    "juil", "août", "sept", "oct", "nov", "déc",
)

# Signs between a month word and its year, and the century of a year.
MONTH_GAP = r"\s./-"
CENTURY = "20"

# What a number format shows literally, its placeholders, and what may follow the comma that scales by a thousand.
FORMAT_LITERALS = (r'"[^"]*"', r'\\(?:"[^"]*")*+.')
PLACEHOLDER = "[0#?]"
AFTER_SCALE = "[^0#?.,%]"

# A number in scientific notation.
SCIENTIFIC = r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)[Ee][+-]?\d+$"

# Published decimals by column name, the first match counts.
PUBLISHED_PLACES = (
    ("*_pct", 1), ("*_points", 1), ("dossiers_*", 0), ("*_mad", 0), ("*_mdh", 0), ("*_unites", 0),
)

# Families of layouts.
ACTIVITY = "apsf_activity"
SUMMARY = "apsf_competitor_summary"
QUARTERLY = "apsf_competitor_quarterly"
DETAILS = "production_marque_details"
PENETRATION = "production_marque_penetration"
CONCESSION = "production_marque_concession"
PIVOT_STAGING = "production_marque_pivot_staging"
VARIATION = "production_marque_variation_tpr"

# Sections that hold amounts, and the one that holds ratios.
MONETARY_SECTIONS = ("PRODUCTION_NETTE", "ENCOURS_SAIN", "CREANCES_EN_SOUFFRANCE", "ENCOURS_BRUT")
RATIO_SECTION = "CES_SUR_ENCOURS_BRUT"

# Default labels of the market rows, quarter headers, grand total.
MARKET_LABEL = "Marché"
MARKET_SHARE_LABEL = "Part de marché"
QUARTERS = ("T1", "T2", "T3", "T4")
GRAND_TOTAL = "TOTAL_GENERAL"
SEVERAL_ITEMS = "PLUSIEURS_ELEMENTS"
ROW_LABELS_ANCHOR = "Étiquettes de lignes"

# Default title area of the competitor layouts, default section, default lookback.
COMPETITOR_TITLE_AREA = {"first_row": 1, "last_row": 8, "first_column": 1, "last_column": 12}
DEFAULT_SECTION = "ACTIVITE"
DEFAULT_LOOKBACK = 8

# Axes of the penetration layout whose values are percentages.
PERCENTAGE_AXES = ("TAUX_DE_PENETRATION", "VARIATION_TPR")

# Measure columns of the activity layout.
ACTIVITY_MEASURES = (
    "montant_reference_mad", "montant_comparaison_mad",
    "dossiers_reference", "dossiers_comparaison",
    "variation_montant_mad", "variation_montant_pct",
    "variation_dossiers_unites", "variation_dossiers_pct",
)

# Exact header of every published table.
HEADERS = {
    "activity": (
        "organisme", "date_reporting", "section", "type_pret", "categorie", "produit",
        "annee_reference", "annee_comparaison", "montant_reference_mad",
        "montant_comparaison_mad", "dossiers_reference", "dossiers_comparaison",
        "variation_montant_mad", "variation_montant_pct", "variation_dossiers_unites",
        "variation_dossiers_pct", "ordre_section", "ordre_ligne",
    ),
    "summary": (
        "date_reporting", "section", "organisme", "categorie", "periode_reference",
        "periode_comparaison", "valeur_reference_mdh", "valeur_comparaison_mdh",
        "evolution_pct", "marche_reference_mdh", "marche_comparaison_mdh",
        "evolution_marche_pct", "ratio_reference_pct", "ratio_comparaison_pct",
        "evolution_ratio_points", "marche_ratio_reference_pct",
        "marche_ratio_comparaison_pct", "evolution_marche_ratio_points",
    ),
    "staging": (
        "date_reporting", "sheet", "section", "category_label_raw",
        "period_label_raw", "row_label_raw", "row_type", "value",
        "number_format", "source_row", "source_column",
    ),
    "quarterly": (
        "date_reporting", "section", "organisme", "categorie", "annee",
        "t1_mdh", "t2_mdh", "t3_mdh", "t4_mdh",
        "marche_t1_mdh", "marche_t2_mdh", "marche_t3_mdh", "marche_t4_mdh",
        "t1_pct", "t2_pct", "t3_pct", "t4_pct",
        "marche_t1_pct", "marche_t2_pct", "marche_t3_pct", "marche_t4_pct",
    ),
    "details": ("marque", "nombre", "ville", "mois", "annee", "source"),
    "penetration": ("marque", "ville", "periodicite", "dimension", "axe", "sous_axe", "valeur"),
    "concession": (
        "groupe_concessionnaire", "annee", "marque", "aivam", "sofac", "total", "row_type",
    ),
    "pivot_staging": (
        "sheet", "bloc_index", "axe", "periodicite", "annee", "mois",
        "dimension", "marque", "ville", "organisme", "valeur",
    ),
    "variation": ("ville", "axe", "valeur"),
}
