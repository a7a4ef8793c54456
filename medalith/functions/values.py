"""Codes, word lists and formats that results depend on."""

# INSEE region code -> two-character department prefixes of a commune code.
DEPARTMENTS_BY_REGION = {
    "11": ("75", "77", "78", "91", "92", "93", "94", "95"),
    "24": ("18", "28", "36", "37", "41", "45"),
    "27": ("21", "25", "39", "58", "70", "71", "89", "90"),
    "28": ("14", "27", "50", "61", "76"),
    "32": ("02", "59", "60", "62", "80"),
    "44": ("08", "10", "51", "52", "54", "55", "57", "67", "68", "88"),
    "52": ("44", "49", "53", "72", "85"),
    "53": ("22", "29", "35", "56"),
    "75": ("16", "17", "19", "23", "24", "33", "40", "47", "64", "79", "86", "87"),
    "76": ("09", "11", "12", "30", "31", "32", "34", "46", "48", "65", "66", "81", "82"),
    "84": ("01", "03", "07", "15", "26", "38", "42", "43", "63", "69", "73", "74"),
    "93": ("04", "05", "06", "13", "83", "84"),
    "94": ("2A", "2B", "20"),
}

# Overseas region code -> three-character department prefix.
OVERSEAS_DEPARTMENT_BY_REGION = {"01": "971", "02": "972", "03": "973", "04": "974", "06": "976"}

# Commune codes with these prefixes use a three-character department.
OVERSEAS_PREFIXES = ("97", "98")

# Arrondissement prefix -> commune code it is folded into.
ARRONDISSEMENT_COMMUNES = {"132": "13055", "693": "69123", "751": "75056"}

# The older rent table partitions the Lyon arrondissements under another code.
LEGACY_ARRONDISSEMENT_PARTITIONS = {"132": "13055", "693": "69300", "751": "75056"}

# Arrondissement codes of the three cities as (first, last, commune).
ARRONDISSEMENT_RANGES = ((13201, 13216, "13055"), (69381, 69389, "69123"), (75101, 75120, "75056"))

# Pole names that are shortened to their first word.
POLE_NAME_PREFIXES = ("Hesdin", "Cugand")

# Texts that mean "true" in the station and in the job-posting feeds.
STATION_TRUE_TEXTS = ("O", "true")
POSTING_TRUE_TEXTS = ("true", "True", "1", "t")

# Label of the high-speed line category, and the default host status.
HIGH_SPEED_CATEGORY = "Ligne à grande vitesse"
DEFAULT_HOST_STATUS = "Sans statut"

# Attraction-area code that means "outside every area".
NO_AREA_CODE = "000"

# Formats checked by the quality rules.
SIRET_FORMAT = "^[0-9]{14}$"
ROME_FORMAT = "^[A-Z][0-9]{4}$"
STRUCTURE_TYPES = ("ETTI", "ACI", "EI", "AI")

# Names of the four audit columns.
AUDIT_COLUMNS = ("job_insert_id", "job_insert_date_utc", "job_modify_id", "job_modify_date_utc")

# Messages of the data-quality checks.
CHECK_MESSAGES = {
    "counts": "Old: %d rows, New: %d rows",
    "preserved": "All %d unique values preserved",
    "missing": "Missing %d values in new table",
    "fk_valid": "All %d FK values valid",
    "fk_orphaned": "Found %d orphaned FK values",
    "nulls": "NULLs or missing: ",
    "no_nulls": "No NULLs found in %d required columns",
    "no_column": "Column %s not found",
    "unique": "All %d values are unique and non-NULL",
    "duplicates": "Found %d duplicates and %d NULLs",
    "audited": "All 4 metadata columns present and populated",
}
