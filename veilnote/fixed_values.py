"""Fixed values.

Word lists, lookup tables, patterns and output formats that must have exactly
these values for results to be right.  They are data, not tuning knobs.
"""

# --- Words that never count as a name or place on their own -----------------
GENERIC_TERMS = (
    "home", "house", "school", "hospital", "clinic", "centre", "center",
    "community", "family", "mother", "father", "parent", "carer", "mum", "dad",
    "therapist", "doctor", "nurse", "worker", "coordinator", "participant",
    "client", "patient", "assessment", "therapy", "treatment", "support",
    "service", "services", "disability", "health", "care", "medical",
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
    "australian", "national", "royal", "general", "main", "primary",
    "street", "road", "avenue", "drive", "lane", "court", "place",
    "suburb", "city", "town", "village",
)

# --- Titles dropped from the front of a name (each with or without a dot) ---
TITLES = ("Dr", "Mr", "Ms", "Mrs", "Prof")

# --- Formal first name -> short form; used both ways ------------------------
NICKNAMES = {
    "David": "Dave", "Michael": "Mike", "William": "Bill",
    "Robert": "Bob", "Elizabeth": "Liz", "Katherine": "Kate",
    "Harrison": "Harry", "Christopher": "Chris", "Daniel": "Dan",
}

# --- Span labels: priority (lower wins an overlap) and replacement tag ------
SPAN_PRIORITY = {"NDIS": 1, "PHONE": 1, "EMAIL": 1, "DOB": 1, "LOCATION": 4}
SPAN_TAG = {
    "NDIS": "[NDIS_REDACTED]", "PHONE": "[PHONE]", "EMAIL": "[EMAIL]",
    "DOB": "[DOB]", "LOCATION": "[LOCATION]",
}

# --- Detector patterns ------------------------------------------------------
NDIS_PATTERN = r"\b\d{9}\b"
PHONE_PATTERNS = (
    r"\+61[\s-]?[2-478][\s-]?\d{4}[\s-]?\d{4}",
    r"\+61[\s-]?4\d{2}[\s-]?\d{3}[\s-]?\d{3}",
    r"\b\(?0[2-478]\)?[\s-]?\d{4}[\s-]?\d{4}\b",
    r"\b04\d{2}[\s-]?\d{3}[\s-]?\d{3}\b",
)
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
DOB_PATTERN = (
    r"(?:D\.?\s*O\.?\s*B\.?|DOB|Date of Birth|Born)[:\s]+"
    r"\d{1,2}[/.\-]\d{1,2}[/.\-]\d{2,4}"
)
ADDRESS_PATTERN = (
    r"\d+[/.-]?\d*\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2}\s+"
    r"(?:Street|St|Road|Rd|Avenue|Ave|Drive|Dr|Lane|Ln|Court|Ct"
    r"|Crescent|Cres|Boulevard|Blvd)"
)
ADDRESS_STOP_WORDS = ("hours", "hrs", "mins", "score")
STATES = (
    "VIC", "NSW", "QLD", "WA", "SA", "TAS", "ACT", "NT",
    "Victoria", "Queensland", "New South Wales", "Western Australia",
    "South Australia", "Tasmania", "Northern Territory",
)
SUBURB_POSTCODE_PATTERN = (
    r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?),\s+"
    r"(?:VIC|NSW|QLD|WA|SA|TAS|ACT|NT)?\s*(\d{4})\b"
)
POSTCODE_RANGE = (200, 9999)
POSTCODE_YEAR_LIKE = (2020, 2030)
STREET_PART_PATTERN = (
    r"(\d+[/.-]?\d*\s+[A-Za-z].*?"
    r"(?:Street|St|Road|Rd|Avenue|Ave|Drive|Dr|Lane|Ln|Court|Ct))"
)

# --- Note export headers: logical field -> accepted names, in order ---------
HEADER_ALIASES = {
    "date": ("Date", "Service Date", "Start Date"),
    "first_name": ("First Name", "Client First Name", "Participant First Name"),
    "last_name": ("Last Name", "Client Last Name", "Participant Last Name"),
    "full_name": ("Client Name",),
    "note": ("Note", "Progress Note", "Case Note", "Description", "Notes"),
    "staff": ("Support Worker", "Created By", "Staff", "Worker"),
    "ndis": ("NDIS Number", "NDIS No.", "NDIS"),
    "dob": ("Date of Birth", "DOB"),
    "service_type": ("Service Type",),
}

# --- Dictionary row types -> (replacement tag, counter label, is a person) --
DICTIONARY_TYPES = {
    "Carer": ("[CARER_NAME]", "CARER_NAME", True),
    "Provider": ("[STAFF_NAME]", "STAFF_NAME", True),
    "Participant": ("[PARTICIPANT]", "PARTICIPANT", True),
    "Organization": ("[ORGANIZATION]", "ORGANIZATION", False),
    "Location": ("[LOCATION]", "LOCATION", False),
}
STAFF_TAG, STAFF_LABEL = "[STAFF_NAME]", "STAFF_NAME"
NAME_LABEL_PREFIX = "NAME→"

# --- Names, ids and rendered text -------------------------------------------
CODE_FORMAT = "PART-%03d"
NOTE_FILE_PATTERN = r"(?i)^(\d{4}-\d{2}-\d{2})-(PART-\d+)\.txt$"
CLEAN_MARKER = "--- DE-IDENTIFIED NOTE ---"
QUARANTINE_BANNER = "*** QUARANTINED — DO NOT DISTRIBUTE ***"
QUARANTINE_MARKER = "--- DE-IDENTIFIED TEXT (INCOMPLETE) ---"
RESIDUAL_REASONS = (
    "Residual NDIS-pattern numbers in output: ",
    "Residual phone numbers in output: ",
    "Residual email addresses in output: ",
)
LEDGER_COLUMNS = (
    "Run Date", "Run At (ISO)", "Notes Exported", "Notes Processed",
    "Notes Quarantined", "Notes Skipped", "Errors", "CSV File",
)
LEDGER_ERROR_SUFFIX = " note(s) errored — check pipeline.log"
REPORT_METRICS = (
    ("Total notes fetched", "total"),
    ("Uploaded to Pending", "uploaded"),
    ("Quarantined", "quarantined"),
    ("Skipped (already processed)", "skipped"),
    ("Errors", "errors"),
)
