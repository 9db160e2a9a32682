"""Fixed values for the oracle texts, written out apart from the code that they check."""

# Provincial area codes.
AREA_CODES = (
    "32", "33", "34", "35", "36", "38", "42", "43", "44", "45", "46", "47", "48", "49", "52", "53", "54", "55", "56",
    "62", "63", "64", "65", "68", "72", "74", "75", "77", "78", "82", "83", "84", "85", "86", "87", "88",
)

# Texts that stand for no e-mail address.
JUNK_EMAILS = (
    "NONE", "NA", "N.A.", "0", "N/A", "---", "--------", "MA", "NODATA", "NULL", "NODATA@YAHOO.COM", "NONE@NONE.COM",
    "NONE@YAHOO.COM", "NA@YAHOO.COM",
)

# Mail domains that are taken as real.
EMAIL_DOMAINS = (
    "GMAIL", "YAHOO", "YMAIL", "HOTMAIL", "ICLOUD", "ROCKETMAIL", "OUTLOOK", "ANZ", "TASKUS", "BMS", "LIVE", "MANULIFE",
    "IQOR", "SYNCHRONYFINANCIAL", "SPI-GLOBAL", "TRANSCOM", "ACCENTURE", "GLOBE", "ALORICA", "CLOUDSTAFF", "QQ",
    "RESULTS-CX", "TENETHEALTH", "PROTONMAIL",
)

# Rate code, months, factor.
AUTO_RATES = """('XSELL_OMA', 60, 0.2985), ('XSELL_OMA', 48, 0.2250), ('XSELL_OMA', 36, 0.1636), ('XSELL_OMA', 24, 0.1068),
    ('XSELL_OMA', 18, 0.0720), ('XSELL_OMA', 12, 0.0457), ('XSELL_STANDARD', 60, 0.3101), ('XSELL_STANDARD', 48, 0.2355),
    ('XSELL_STANDARD', 36, 0.1733), ('XSELL_STANDARD', 24, 0.1158), ('XSELL_STANDARD', 18, 0.0802), ('XSELL_STANDARD', 12, 0.0533)"""
