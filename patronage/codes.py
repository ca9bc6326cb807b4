"""Fixed values shared by all jobs: sentinels, match codes, word lists."""

# ---- fixed values: sentinels -------------------------------------------------
UNKNOWN_KEY = -1
UNKNOWN_TEXT = "UNKNOWN"
DATE_UNKNOWN = "1900-01-01"
DATE_FAR = "9999-01-01"
DATE_MODEL_END = "2099-12-31"
DATE_NO_FILE = "1970-01-01"
STATUS_CURRENT = "current"
STATUS_HISTORY = "history"
EMPTY_CARD = "000000000000000000"

# ---- fixed values: match type codes -----------------------------------------
MATCH_CODES = {
    "plcc_name": 1,
    "plcc": 2,
    "loyalty_id": 4,
    "bank_card_name": 5,
    "bank_card": 6,
    "name_address": 7,
    "ean_rid": 8,
    "phone_email_name": 9,
    "phone_email": 10,
    "phone_name": 11,
    "phone": 12,
    "email_name": 13,
    "email": 14,
    "phone_reverse_append": 15,
    "email_reverse_append": 16,
    "ean_member": 18,
    "plcc_primary": 19,
    "employee_id": 20,
    "alternate_id": 21,
    "ip_code": 22,
    "phone_email_loyalty": 24,
    "plcc_name_loyalty": 25,
    "plcc_loyalty": 26,
    "plcc_email_phone": 27,
    "plcc_email": 28,
    "plcc_phone": 29,
    "ean_prospect": 30,
    "plcc_lookup_queue": 90,
    "email_reverse_append_queue": 91,
    "no_match": 92,
}

# ---- fixed values: phone numbers known to be junk ----------------------------
JUNK_PHONES = [
    "0000000001", "1234567890", "1231231234", "1000000000",
    "0000000123", "2000000000", "0000000002", "8000000000",
]

# ---- fixed values: marketability order (direct mail, e-mail, text message) ---
MARKETABILITY_ORDER = {
    "YES~YES~YES": 1,
    "YES~YES~NO": 2,
    "YES~NO~NO": 3,
    "NO~YES~YES": 4,
    "NO~YES~NO": 5,
    "NO~NO~YES": 6,
}
MARKETABILITY_OTHER = 99

# ---- fixed values: minimum customer definition labels ------------------------
MCD_LOYALTY = "mcd_loyaltyid"
MCD_US = "mcd_name_address_us"
MCD_CANADA = "mcd_name_address_canada"
MCD_CARD = "mcd_bankcard"
MCD_EMAIL = "mcd_email"
MCD_PHONE = "mcd_phone"
MCD_FAILED = "mcd_failed"

# Match meta columns and the values a fresh feed row starts with.
MATCH_META = {"match_status": False, "match_key": MATCH_CODES["no_match"],
              "member_key": UNKNOWN_KEY, "mcd_criteria": "matched"}
