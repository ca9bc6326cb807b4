"""Columns of the member feeds under their names in the member table."""

from __future__ import annotations

# ---- fixed values: feed columns that have another name in the member table ------
META_RENAMES = {"source_key": "current_source_key", "match_key": "match_type_key"}
SCRUBBED_NAME = {"first_name": "first_name_scrubbed", "last_name": "last_name_scrubbed"}
SCRUBBED_PLACE = {"address_1": "address1_scrubbed", "address_2": "address2_scrubbed", "city": "city_scrubbed", "state": "state_scrubbed"}
FEED_MAPPINGS = {
    "employee": {"address": "address1", "zip": "zip_code"},
    "till": {"address_line_1": "address1", "address_line_2": "address2", "non_usa_postal_code": "non_us_postal_code",
             "country": "country_code", "loyalty": "loyalty_id", "customer_number": "ecommerce_customer_nbr"},
    "card_statement": {"street_address": "address1", "zip_plus_4": "zip4", "do_not_direct_mail": "direct_mail_consent",
                       "account_open_date": "direct_mail_consent_date",
                       "do_not_statement_insert": "ads_do_not_statement_insert", "do_not_sell_name": "ads_do_not_sell_name",
                       "spam_indicator": "ads_spam_indicator", "email_change_date": "ads_email_change_date",
                       "return_mail_indicator": "ads_return_mail_ind", "mobile_phone": "phone_nbr",
                       "marketing_promo_flag": "promotion_consent"},
    "card_account": {"street_address": "address1", "zip_plus_4": "zip4"},
    "rental_venus": {"firstname": "first_name", "lastname": "last_name", "statecode": "state", "zipcode": "zip_code"},
    "rental_experian": {"zip": "zip_code"},
    "rental_jcrew": {"address_1": "address1", "address_2": "address2"},
    "rental_anthem": {"prefix": "name_prefix", "firstname": "first_name", "lastname": "last_name", "suffix": "name_suffix", "zip": "zip_code"},
    "mobile_consent": {"firstname": "first_name", "lastname": "last_name", "phone_number": "phone_nbr", "address_line_1": "address1",
                       "zipcode": "zip_code"},
    "email_update": {"address_line_1": "address1"},
    "loyalty": {"nameprefix": "name_prefix", "firstname": "first_name", "lastname": "last_name", "namesuffix": "name_suffix",
                "a_addresslineone": "address1", "a_addresslinetwo": "address2", "ipcode": "ip_code", "a_city": "city", "a_state": "state",
                "a_zipcode": "zip_code", "a_country": "country_code", "a_gender": "gender", "birthdate": "birth_date",
                "memberstatus": "member_status", "membercreatedate": "member_acct_open_date",
                "membercreatedatetime": "member_acct_open_date_time", "memberclosedate": "member_acct_close_date",
                "a_enrolldate": "member_acct_enroll_date", "a_papercertoptin": "printed_cert_opt_in", "a_ecertoptin": "e_cert_opt_in",
                "a_ecertoptindate": "e_cert_opt_in_date", "a_facebookid": "facebook_id", "a_twitterid": "twitter_id",
                "a_enrollmentstorenumber": "lw_enrollment_store_key", "a_county": "county", "a_addressmailable": "address_mailable",
                "a_membersource": "lw_enrollment_source_key", "a_languagepreference": "language_preference",
                "a_securityquestion": "security_question", "a_requestloyaltycard": "request_loyalty_card",
                "a_requestpapercertdate": "request_paper_cert_date", "a_addresstype": "address_type",
                "a_preapprovalnumber": "preapproval_number", "a_preapprovalexpirationdate": "preapproval_expiration_date",
                "a_communicationspref": "communications_pref", "a_cdhmemberkey": "cdh_member_key", "a_optstatus": "opt_status",
                "a_tokennbrassociationrequest": "token_nbr_association_request", "a_confirmageeighteen": "confirm_age_eighteen",
                "a_plccrequestdate": "plcc_request_date", "a_plccrequestuserid": "plcc_request_user_id",
                "a_isplccrequest": "is_plcc_request", "loyalty_id_number": "loyalty_id"},
    "hygiene": {**SCRUBBED_NAME, "primary_address": "address1_scrubbed", "secondary_address": "address2_scrubbed", "city": "city_scrubbed",
                "zipcode": "zip_code_scrubbed", "zip4": "zip4_scrubbed", "state": "state_scrubbed", "is_prison": "address_is_prison",
                "is_deceased": "deceased", "latitude_6_decimals": "latitude", "longitude_6_decimals": "longitude"},
    "reverse_experian": {**SCRUBBED_NAME, **SCRUBBED_PLACE, "postal_code": "zip_code_scrubbed", "zip4_code": "zip4_scrubbed"},
    "reverse_acxiom": {**SCRUBBED_NAME, **SCRUBBED_PLACE, "zip": "zip_code_scrubbed"},
    "phone_acxiom": {**SCRUBBED_NAME, **SCRUBBED_PLACE, "zip_code": "zip_code_scrubbed", "zip4_code": "zip4_scrubbed"},
    "phone_experian": {**SCRUBBED_NAME, **SCRUBBED_PLACE, "zip_code": "zip_code_scrubbed", "zip4_code": "zip4_scrubbed"},
}
MEMBER_STATUS = {1: "ACTIVE", 2: "CANCELED", 3: "CLOSED", 4: "LOCKED", 5: "UNKNOWN", 6: "MERGED"}
SCRUBBED = ["first_name_scrubbed", "last_name_scrubbed", "address2_scrubbed", "address1_scrubbed", "city_scrubbed", "state_scrubbed",
            "zip_code_scrubbed", "zip4_scrubbed"]


def _blank(*names: str) -> dict[str, str]:
    return {n: f"nullif({n}, '')" for n in names}


def _null_text(names: list[str]) -> dict[str, str]:
    return {n: f"nullif({n}, 'NULL')" for n in names}


def _yes_no(*names: str) -> dict[str, str]:
    return {n: f"case when {n} = '1' then 'YES' when {n} = '0' then 'NO' end" for n in names}


_STATUS = "case " + " ".join(f"when member_status = '{k}' then '{v}'" for k, v in MEMBER_STATUS.items()) + " end"

# columns that are set after the renaming, in order, as SQL texts; codes are compared as text
FEED_DERIVED = {
    "till": _blank("gender"),
    "card_statement": {"promotion_consent": "case when promotion_consent = '1' then 'NO' else 'YES' end",
                       "ads_return_mail_ind": "case when ads_return_mail_ind = 'Y' then ads_return_mail_ind end",
                       **_blank("ads_do_not_sell_name", "ads_spam_indicator")},
    "rental_experian": _blank("gender"),
    "loyalty": {**_yes_no("is_plcc_request"), "member_status": _STATUS, **_yes_no("printed_cert_opt_in", "e_cert_opt_in"),
                **_blank("gender"), "member_source": "lw_enrollment_source_key"},
    "hygiene": _blank("address_is_prison", "deceased"),
    "reverse_experian": _null_text(SCRUBBED),
    "phone_experian": _null_text(SCRUBBED),
}
