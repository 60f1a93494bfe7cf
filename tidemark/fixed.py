"""Names, word lists, patterns and limits that results must agree on."""

from __future__ import annotations

# Forms whose filer is the issuer.
DIRECT_FORMS = (
    "8-K", "8-K/A", "10-K", "10-K/A", "10-Q", "10-Q/A", "6-K", "6-K/A", "20-F", "20-F/A", "40-F", "40-F/A",
    "13F-HR", "13F-HR/A", "13F-NT", "13F-NT/A", "N-PORT", "N-PORT/A", "N-PORT-EX", "N-PORT-EX/A", "N-CEN", "N-CEN/A",
    "497", "497K", "497J", "497AD", "485APOS", "485BPOS", "485BXT",
)
# Forms whose header says who the issuer is.
AMBIGUOUS_FORMS = ("3", "3/A", "4", "4/A", "5", "5/A", "SC 13D", "SC 13D/A", "SC 13G", "SC 13G/A")
# Forms about another company.
ACTIVIST_FORMS = ("SC 13D", "SC 13D/A", "SC 13G", "SC 13G/A", "13D", "13G")
# Handlers in their order, with the forms that each takes.
HANDLERS = (
    ("eight_k", r"^8-K"),
    ("ownership", r"^(?:3|4|5)(?:/A)?$"),
    ("thirteen_f", r"^13F-HR(?:/A)?$"),
    ("thirteen_f_notice", r"^13F-NT(?:/A)?$"),
    ("thirteen_dg", r"^(?:SC\s+)?13[DG](?:/A)?$"),
    ("xbrl", r"^(?:10-[KQ]|20-F|40-F|6-K)(?:/A)?$"),
    ("fund", r"^N-PORT(?:-EX)?(?:/A)?$"),
)
# States that no work leaves.
TERMINAL_RELEVANCE = ("irrelevant", "direct_unmatched", "hdr_failed", "unresolved")
TERMINAL_RETRIEVAL = ("retrieved",)
RETRYABLE_RETRIEVAL = ("retrieval_failed", "retrieved_partial")
STRANDED_RETRIEVAL = ("queued", "in_progress")
PRIORITIES = ("live", "retry", "header_gate", "retrieval", "audit", "backfill", "repair")
LIVE_PRIORITIES = ("live", "retry", "header_gate", "retrieval")
MAX_FILING_ATTEMPTS = 5
MAX_PUBLISH_ATTEMPTS = 10
BACKOFF_CAP = 3600
BACKOFF_BASE = 2.0

# Items of a current report.
EIGHT_K_ITEMS = {
    "1.01": "Entry into a Material Definitive Agreement",
    "1.02": "Termination of a Material Definitive Agreement",
    "1.03": "Bankruptcy or Receivership",
    "1.04": "Mine Safety",
    "2.01": "Completion of Acquisition or Disposition of Assets",
    "2.02": "Results of Operations and Financial Condition",
    "2.03": "Creation of a Direct Financial Obligation",
    "2.04": "Triggering Events That Accelerate or Increase a Direct Financial Obligation",
    "2.05": "Costs Associated with Exit or Disposal Activities",
    "2.06": "Material Impairments",
    "3.01": "Notice of Delisting or Failure to Satisfy a Continued Listing Rule",
    "3.02": "Unregistered Sales of Equity Securities",
    "3.03": "Material Modification to Rights of Security Holders",
    "4.01": "Changes in Registrant's Certifying Accountant",
    "4.02": "Non-Reliance on Previously Issued Financial Statements",
    "5.01": "Changes in Control of Registrant",
    "5.02": "Departure/Election of Directors or Principal Officers",
    "5.03": "Amendments to Articles of Incorporation or Bylaws",
    "5.05": "Amendments to the Registrant's Code of Ethics",
    "5.06": "Change in Shell Company Status",
    "5.07": "Submission of Matters to a Vote of Security Holders",
    "5.08": "Shareholder Nominations",
    "7.01": "Regulation FD Disclosure",
    "8.01": "Other Events",
    "9.01": "Financial Statements and Exhibits",
}
# Other titles of items.
EIGHT_K_TITLES = {
    "5.02": (
        "Departure of Directors or Certain Officers; Election of Directors; Appointment of Certain Officers; Compensatory Arrangements of Certain Officers",
        "Departure of Directors or Principal Officers",
    ),
    "7.01": ("Regulation FD", "Reg FD Disclosure", "Reg FD"),
    "9.01": ("Financial Statements & Exhibits",),
}
# Patterns of facts in current reports (item, fact, key, pattern; the amount, then its unit).
AMOUNT = r"\$\s*([\d,]+(?:\.\d+)?)\s*(million|billion|thousand|M|B|K)?"
EIGHT_K_FACTS = (
    ("2.02", "earnings_eps", "eps", r"(?i)(?:earnings?\s+per\s+share|EPS)[^$\d]*?\$?\s*([\d]+\.\d{2,4})"),
    ("2.02", "revenue", "revenue", r"(?i)(?:revenue|net\s+sales|total\s+revenue)[^$]*?" + AMOUNT),
    ("2.02", "net_income", "net_income", r"(?i)(?:net\s+income|net\s+loss|net\s+(?:income|loss)\s+attributable)[^$]*?" + AMOUNT),
    ("2.02", "guidance", "guidance_amount", r"(?i)(?:guidance|outlook|expect(?:s|ed|ing)?|forecast|project(?:s|ed|ing)?)[^.]{0,200}?" + AMOUNT),
    ("2.01", "deal_value", "deal_value", r"(?i)(?:purchase\s+price|acquisition\s+price|deal\s+value|aggregate\s+consideration|transaction\s+value)[^$]*?" + AMOUNT),
    ("5.02", "management_change", "ceo_change_detected", r"(?i)(?:appointed|named|elected|promoted)\s+(?:as\s+)?(?:Chief\s+Executive\s+Officer|CEO|President)|(?:Chief\s+Executive\s+Officer|CEO|President)\s+(?:will\s+)?(?:resign|retire|step\s+down|depart)"),
    (None, "dividend", "dividend_per_share", r"(?i)(?:dividend|distribution)\s+of\s+\$\s*([\d]+\.\d{2,4})\s+per\s+share"),
)
# Patterns of beneficial ownership reports.
DG_PERCENT = r"(?i)(?:percent(?:age)?\s+(?:of\s+)?(?:class|shares|securities|outstanding))[^0-9]*?(\d{1,3}(?:\.\d+)?)\s*%"
DG_PERCENT_SIMPLE = r"(?i)(\d{1,3}\.\d+)\s*%\s*(?:of\s+(?:the\s+)?(?:outstanding|class|shares))"
DG_SHARES = r"(?i)(?:aggregate\s+number|number\s+of\s+shares|shares?\s+beneficially\s+owned)[^0-9]*?([\d,]+(?:\.\d+)?)"
DG_CUSIP = r"(?i)CUSIP\s*(?:No\.?|Number)?\s*[:\s]*([A-Z0-9]{6,9})"
DG_EVENT_DATE = r"(?i)DATE\s+OF\s+EVENT[^:]*:\s*(\w+\s+\d{1,2},?\s+\d{4}|\d{1,2}/\d{1,2}/\d{2,4}|\d{4}-\d{2}-\d{2})"
DG_AMENDMENT = r"(?i)AMENDMENT\s+NO\.?\s*:?\s*(\d+)"
# Labels of a fund report shown as a page, with what they tell.
FUND_LABELS = {
    "series id": "series_id", "seriesid": "series_id", "series name": "series_name", "seriesname": "series_name", "class id": "class_id", "classid": "class_id",
    "report date": "report_date", "reporting period": "report_date", "reppd": "report_date", "total assets": "total_assets", "totassets": "total_assets",
    "net assets": "net_assets", "netassets": "net_assets",
}
# Column names by which such a page's table of holdings is known.
FUND_HEADINGS = ("name", "cusip", "isin", "balance", "value", "valussd", "valusd", "title", "lei")
ACCESSION = r"\d{10}-\d{2}-\d{6}"
ISIN = r"^[A-Z]{2}[A-Z0-9]{10}$"

# Feeds of the news-event dumps (name, list, file pattern, record key, document id).
FEEDS = (
    ("events_en", "master", r"/\d{14}\.export\.CSV\.zip$", "first_field", "last_field_url"),
    ("mentions_en", "master", r"/\d{14}\.mentions\.CSV\.zip$", "line_sha256", "field_6"),
    ("gkg_en", "master", r"/\d{14}\.gkg\.csv\.zip$", "first_field", "first_url_in_10"),
    ("events_trans", "translation", r"/\d{14}\.translation\.export\.CSV\.zip$", "first_field", "last_field_url"),
    ("mentions_trans", "translation", r"/\d{14}\.translation\.mentions\.CSV\.zip$", "line_sha256", "field_6"),
    ("gkg_trans", "translation", r"/\d{14}\.translation\.gkg\.csv\.zip$", "first_field", "first_url_in_10"),
)

# Subjects of the event log.
SUBJECTS = {
    "retrieved": "edgar.filing.retrieved",
    "retrieved_partial": "edgar.filing.retrieved_partial",
    "failed": "edgar.filing.failed",
    "ownership": "edgar.form4.parsed",
    "eight_k_item": "edgar.8k.item_detected",
    "eight_k_facts": "edgar.8k.facts_extracted",
    "feed_gap": "edgar.feed.gap_detected",
    "thirteen_f": "edgar.13f.parsed",
    "thirteen_f_notice": "edgar.13f_nt.parsed",
    "thirteen_dg": "edgar.13dg.parsed",
    "xbrl": "edgar.xbrl.parsed",
    "fund": "edgar.fund.parsed",
}

# Words that company names are compared without.
GENERIC_WORDS = (
    "A", "ADR", "AG", "AND", "ASA", "B", "CLASS", "CO", "COM", "COMPANY", "CORP", "CORPORATION", "DE", "GROUP", "HOLDING", "HOLDINGS",
    "INC", "INCORPORATED", "INTL", "INTERNATIONAL", "LIMITED", "LTD", "LLC", "NV", "OF", "ORD", "ORDINARY", "PLC", "SA", "SE", "SPA", "THE",
    "PJSC", "JSC", "OJSC", "CJSC", "AB", "SAB", "CV", "SABDECV", "KK", "BERHAD", "BHD", "TBK", "PT", "TBHK", "TAS", "KGAA", "GMBH", "SRL",
    "SARL", "SGPS", "AD", "DD", "AS", "OYJ", "ABP", "PUBL", "HF",
)
# Words of share classes that widen a search when left out.
RECALL_WORDS = (
    "REG", "ORD", "NEW", "EO", "DL", "SHS", "SHARES", "UNSP", "REGISTERED", "BEARER", "NOMINAL", "NAMENS", "INHABER", "VINKULIERT", "VINK",
    "NA", "BR", "PREF", "PREFERRED", "PREFERENCE", "PREFS", "NVDR", "DR", "GDR", "ADR", "NPV", "PAR",
)
# Transliterations and abbreviations that widen a search.
TRANSLITERATIONS = (("UE", "U"), ("OE", "O"), ("AE", "A"))
ABBREVIATIONS = {
    "RUECKVER": "RUCKVERSICHERUNGS", "RUCKVER": "RUCKVERSICHERUNGS", "INTL": "INTERNATIONAL", "MFG": "MANUFACTURING", "HLDGS": "HOLDINGS",
    "HLDG": "HOLDING", "GRP": "GROUP", "SVCS": "SERVICES", "SVC": "SERVICE", "TECH": "TECHNOLOGY", "TECHS": "TECHNOLOGIES",
    "FIN": "FINANCIAL", "FINL": "FINANCIAL", "FINANCIERO": "FINANCIAL", "PHARMA": "PHARMACEUTICAL", "CHEM": "CHEMICAL", "ELEC": "ELECTRIC",
    "ELECTR": "ELECTRONIC", "NAT": "NATIONAL", "NATL": "NATIONAL", "MGT": "MANAGEMENT", "MGMT": "MANAGEMENT", "DEV": "DEVELOPMENT",
    "PROP": "PROPERTIES", "RES": "RESOURCES", "COMM": "COMMERCIAL", "TELECOMM": "TELECOMMUNICATIONS", "BANCSHRS": "BANCSHARES",
    "SYS": "SYSTEMS", "SOLS": "SOLUTIONS", "INDS": "INDUSTRIES", "IND": "INDUSTRIAL", "PRODS": "PRODUCTS", "PETRO": "PETROLEUM",
    "ENTMT": "ENTERTAINMENT", "ENGY": "ENERGY", "PWR": "POWER", "INS": "INSURANCE", "ASSUR": "ASSURANCE", "BK": "BANK", "BKG": "BANKING",
    "BANCORP": "BANCORP", "BANC": "BANK", "SECS": "SECURITIES", "MTG": "MORTGAGE", "GOVT": "GOVERNMENT", "REINS": "REINSURANCE",
    "TRANSN": "TRANSPORTATION", "TRANSP": "TRANSPORTATION", "AUTO": "AUTOMOBILE", "AUTOS": "AUTOMOBILES", "CONSTRUCTN": "CONSTRUCTION",
    "ENGR": "ENGINEERING", "INVT": "INVESTMENT", "INVTS": "INVESTMENTS",
}
# Endings of constituent names.
CURRENCIES = (
    "USD", "EUR", "GBP", "JPY", "CHF", "CAD", "AUD", "HKD", "TWD", "KRW", "SEK", "DKK", "NOK", "SGD", "INR", "BRL", "ZAR", "MXN", "CNY",
    "NZD", "CLP", "THB", "IDR", "MYR", "PHP", "PLN", "CZK", "HUF", "ILS", "TRY", "ARS", "COP", "PEN", "QAR", "SAR", "AED", "KWD", "RON",
    "ISK", "NPV",
)
PAR_VALUE = rf"(?i)\s+(?:{'|'.join(CURRENCIES)})\S*(?:\s.*)?$"
DEPOSITARY = r"(?i)\s*-\s*(?:SP(?:ON(?:S)?)?\s+)?(?:ADR|GDR)(?:\s+.*)?$|\s*-\s*REG\s+S$"
PREFERRED = r"(?i)\s+NON-CUM\s+PRF\s+SHS$"
US_EXCHANGES = ("US", "UA", "UN", "UQ", "UR", "UW", "UP", "UM")
# Bounds of the latency buckets, in seconds.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0)
