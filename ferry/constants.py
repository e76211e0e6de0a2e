"""Fixed values that must equal the original jobs' values for equal results.

Everything here is a default; every operator takes the value as a parameter.
"""

# --- fixed values: e-mail domain alias fold (identity match key) -------------------------
# First domain labels treated as one company, and the label they fold to.
DOMAIN_ALIASES = ("bigcommerce", "feedonomics", "commerce")
DOMAIN_CANONICAL = "bigcommerce"

# --- fixed values: exportable-field selection (metadata-driven extract) -------------------
# Compound field names that the bulk extract cannot select.
COMPOUND_FIELDS_TO_SKIP = (
    "BillingAddress", "ShippingAddress", "MailingAddress", "OtherAddress", "Address",
    "QuoteToAddress", "AdditionalAddress", "pkbgeolocalization__c",
)
# Field types that the bulk extract cannot select (compared lower-cased on both sides).
UNSUPPORTED_FIELD_TYPES = ("address", "location", "base64", "encryptedstring", "anytype")

# --- fixed values: contract eligibility (document manifests) -------------------------------
ELIGIBLE_ACCOUNT_STATUSES = (
    "Migrated-PREPROD", "Migrated-PROD", "Migrated-PREPROD(Partner)", "Migrated-PROD(Partner)",
)
ELIGIBLE_CREATED_ON_OR_BEFORE = "2025-11-20"

# --- fixed values: loading ----------------------------------------------------------------
BULK_BATCH_SIZE = 20000
ATTACHMENT_CONTENT_TYPE = "application/pdf"
# Load-time stamp: UTC, ISO-8601 with milliseconds and a literal Z.
RUN_ID_FORMAT = "%Y%m%d_%H%M%S"
# Outcome names of a bulk job.
OUTCOMES = ("success", "error", "unprocessed")

# --- fixed values: line-break scrub ---------------------------------------------------------
LINE_BREAK_CHARS = "\n\r"
LINE_BREAK_REPLACEMENT = " "

# --- fixed values: objects and the steps that apply to them --------------------------------
# Objects whose earlier crosswalk is registered as a view for the transforms.
REGISTERED_OBJECTS = (
    "account", "contact", "opportunity", "lead", "product2", "opportunitylineitem",
    "partnercommissionsummary__c", "store__c", "storecontactrole__c", "salesreferral__c",
    "zuora__product__c", "opportunitystoreassociation__c", "task", "case",
    "ironclad__ironclad_contract__c", "event", "campaign", "certification__c",
    "invoicetransaction__c", "deal_registration__c", "project__c", "projectrole__c",
    "getfeedback_aut__survey__c", "getfeedback_aut__response__c", "projectproduct__c",
    "campaignmember", "ironclad__ironclad_workflow__c", "ironclad__ironclad_signature__c",
    "billingaccount__c", "emailmessage", "partnerapp__c", "partnercommissionpayment__c",
    "partnerpayment__c", "partnercommissioninvoicetransaction__c", "product_account__c",
    "subscription__c",
)
# Objects whose transform is checked for orphaned source records.
ORPHAN_CHECKED_OBJECTS = (
    "account", "contact", "opportunity", "lead", "product2", "opportunitylineitem",
    "partnercommissionsummary__c", "accountteammember", "store__c", "storecontactrole__c",
    "salesreferral__c", "opportunitystoreassociation__c", "task", "case",
    "ironclad__ironclad_contract__c", "event", "campaign", "certification__c",
    "invoicetransaction__c", "deal_registration__c", "project__c", "projectrole__c",
    "getfeedback_aut__survey__c", "getfeedback_aut__response__c", "projectproduct__c",
    "campaignmember", "ironclad__ironclad_workflow__c", "ironclad__ironclad_signature__c",
    "billingaccount__c", "emailmessage", "partnerapp__c", "partnercommissionpayment__c",
    "partnerpayment__c", "partnercommissioninvoicetransaction__c", "product_account__c",
    "subscription__c",
)
# Objects that get a load-time stamp.
STAMPED_OBJECTS = (
    "account", "lead", "opportunity", "contact", "product2", "opportunitylineitem",
    "partnercommissionsummary__c", "accountteammember", "store__c", "storecontactrole__c",
    "salesreferral__c", "opportunitystoreassociation__c", "task", "ironclad__ironclad_contract__c",
    "event", "campaign", "certification__c", "invoicetransaction__c", "deal_registration__c",
    "project__c", "getfeedback_aut__survey__c", "getfeedback_aut__answer__c",
    "getfeedback_aut__response__c", "projectrole__c", "projectproduct__c",
    "ironclad__ironclad_workflow__c", "ironclad__ironclad_signature__c", "campaignmember", "case",
    "billingaccount__c", "emailmessage", "partnerapp__c", "partnercommissionpayment__c",
    "partnerpayment__c", "partnercommissioninvoicetransaction__c", "product_account__c",
    "subscription__c",
)

# One row per object with a flag for each step (derived from the three lists above):
# (name, registered as a crosswalk view, orphan-checked, stamped at load).
OBJECT_STEPS = tuple(
    (name, name in REGISTERED_OBJECTS, name in ORPHAN_CHECKED_OBJECTS, name in STAMPED_OBJECTS)
    for name in dict.fromkeys(REGISTERED_OBJECTS + ORPHAN_CHECKED_OBJECTS + STAMPED_OBJECTS)
)
# Objects whose success outcomes get an extra copy for the next transform's lookups.
EXTRA_SUCCESS_COPY_OBJECTS = ("account", "contact")
