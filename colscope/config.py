"""Settings of a profile. The defaults are fixed values: results depend on them."""

from __future__ import annotations

from dataclasses import dataclass

# Pairs of texts that make a boolean group, lower-cased. A group of one value is boolean only if it is x.
BOOLEAN_PAIRS = (("1", "0"), ("1", ""), ("yes", "no"), ("y", "n"), ("true", "false"), ("t", "f"), ("si", "no"), ("s", "n"), ("verdadero", "falso"), ("v", "f"), ("x", ""))

# Uses from the most generic to the most specific.
USE_RANK = {
    "FreeText": 100, "StandardText": 95, "StandardDescription": 93, "TextCode": 90, "CodeWithoutSpaces": 85, "AlphaNumericCode": 80, "DecimalValue": 75, "IntegerValue": 70,
    "NumericCode": 60, "Boolean": 50, "DateTime": 40, "Date": 38, "Time": 36, "Email": 30, "ZerosOnly": 10, "Empty": 5,
}

# Abbreviations of uses.
USE_ABBREVIATION = {
    "Empty": "EP", "StandardText": "ST", "StandardDescription": "ST", "AlphaNumericCode": "AC", "NumericCode": "NC", "TextCode": "TC", "FreeText": "FT", "IntegerValue": "IV", "DecimalValue": "DV",
    "DateTime": "DT", "Date": "DA", "Time": "TI", "Boolean": "BO", "Email": "EM", "CodeWithoutSpaces": "CW", "ZerosOnly": "ZP",
}

# Abbreviations of SQL types; VARCHAR(n) is VCn, anything else UN. The slim document knows no DATE, TIME, TIMESTAMP.
TYPE_ABBREVIATION = {"INT": "IN", "BIGINT": "BI", "TINYINT(1)": "TI", "CHAR(1)": "CH", "DECIMAL(38,10)": "DE", "DATETIME": "DT", "DATE": "DA", "TIME": "TM", "TIMESTAMP": "TS"}
META_TYPE_ABBREVIATION = {k: v for k, v in TYPE_ABBREVIATION.items() if k not in ("DATE", "TIME", "TIMESTAMP")}

# Parts of the names of files that are profiled, case counting.
FILE_PATTERNS = (
    "MB51", "MB5B", "ME5A", "S_P99_41000062", "ME2L", "ZMMR_SQVI_BUS_RAPIDA", "ZMMREPO", "MRO_IO", "KOB1", "CJI3", "KSB1", "ZFIR_STATSLOAD", "CN41N", "ZRPT_PS_PROJECT", "IW49N",
    "LEK2DAT_FORECAST", "LEK2DAT_STRUCTURE_EE", "LEK2DAT_STRUCTURE_CC", "LEK2DAT_STRUCTURE_CCEE", "LEK2DAT_STRUCTURE_ACC", "PRESU", "PATRI",
)

NUMERIC_USES = ("DecimalValue", "IntegerValue", "NumericCode")
DATETIME_USES = ("DateTime", "Date", "Time")
CODE_USES = ("NumericCode", "TextCode", "AlphaNumericCode", "CodeWithoutSpaces")


@dataclass(frozen=True)
class ProfileConfig:
    varchar_sizes: tuple[int, ...] = (5, 20, 50, 100, 150, 250)
    number_samples: int = 2000
    prefer_order: str = "DMY"
    two_digit_pivot: int = 50
    first_year: int = 1990
    last_year: int = 2150
    mostly: float = 0.9
    force_numeric_share: float = 0.95
    force_date_share: float = 0.20
    force_homogeneity: float = 0.3
    outlier_range: float = 100_000
    serial_hint_share: float = 0.8
    mismatch_share: float = 0.60
    int_digits: int = 6
    top_values: int = 10
    key_width: int = 5
    blocked_key_uses: tuple[str, ...] = ("ZerosOnly", "Empty", "DecimalValue")
    #: Combinations of a key search at most, if a limit is wanted; beyond, the result says that the search was cut short.
    key_candidates: int | None = None
    small_files: int = 5
    large_file_mb: float = 20
    most_failures: int = 3
    small_seconds: int = 120
    large_seconds: int = 600
    #: Only files whose name has one of these are profiled; all if there is none.
    file_patterns: tuple[str, ...] = FILE_PATTERNS


DEFAULT = ProfileConfig()
