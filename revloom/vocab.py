"""Fixed values shared by the models.  Each block is data, not logic."""

from __future__ import annotations

# Funnel stages, in order.
LIFECYCLE_STAGES = (
    "lead",
    "marketingqualifiedlead",
    "salesqualifiedlead",
    "opportunity",
    "customer",
)

# Funnel stage labels used by reports.
LIFECYCLE_LABELS = {
    "lead": "Lead",
    "marketingqualifiedlead": "MQL",
    "salesqualifiedlead": "SQL",
    "opportunity": "Opportunity (SQO)",
    "customer": "Customer",
}

# Deal stages that end a deal.
STAGE_WON = "closedwon"
STAGE_LOST = "closedlost"

# Open deal stages (id, label, display order, win probability).
OPEN_STAGES = (
    ("appointmentscheduled", "Appointment Scheduled", 1, "0.2"),
    ("qualifiedtobuy", "Qualified To Buy", 2, "0.4"),
    ("presentationscheduled", "Presentation Scheduled", 3, "0.6"),
    ("decisionmakerboughtin", "Decision Maker Bought-In", 4, "0.8"),
    ("contractsent", "Contract Sent", 5, "0.9"),
)

# The sample company every new CRM account starts with.
SAMPLE_COMPANY_NAME = "HubSpot"

# Test mailboxes, then onboarding sample mailboxes.
TEST_EMAILS = ("test@test.com", "qa-bot@example.com", "delete-me@nowhere.com")
SAMPLE_EMAILS = ("emailmaria@hubspot.com", "bh@hubspot.com")

# Labels of primary associations.
CONTACT_COMPANY_LABEL = "contact_to_company"
DEAL_COMPANY_LABEL = "deal_to_company"
LINE_ITEM_DEAL_LABEL = "line_item_to_deal"

# Subscription states.
STATUS_ACTIVE = "active"
STATUS_CHURNED = "churned"

# Tracked properties per entity as (name, type, field type).
TRACKED_PROPERTIES = {
    "companies": (
        ("name", "string", "text"),
        ("domain", "string", "text"),
        ("industry", "enumeration", "select"),
        ("numberofemployees", "number", "number"),
        ("annualrevenue", "number", "number"),
        ("city", "string", "text"),
        ("country", "string", "text"),
        ("createdate", "datetime", "date"),
        ("hs_lastmodifieddate", "datetime", "date"),
    ),
    "contacts": (
        ("firstname", "string", "text"),
        ("lastname", "string", "text"),
        ("email", "string", "text"),
        ("jobtitle", "string", "text"),
        ("phone", "string", "phonenumber"),
        ("lifecyclestage", "enumeration", "radio"),
        ("createdate", "datetime", "date"),
        ("hs_lastmodifieddate", "datetime", "date"),
    ),
    "deals": (
        ("dealname", "string", "text"),
        ("amount", "number", "number"),
        ("dealstage", "enumeration", "radio"),
        ("dealtype", "enumeration", "radio"),
        ("pipeline", "enumeration", "select"),
        ("closedate", "datetime", "date"),
        ("createdate", "datetime", "date"),
        ("hs_lastmodifieddate", "datetime", "date"),
    ),
    "line_items": (
        ("name", "string", "text"),
        ("quantity", "number", "number"),
        ("price", "number", "number"),
        ("amount", "number", "calculation_equation"),
        ("hs_product_id", "number", "number"),
        ("createdate", "datetime", "date"),
        ("hs_lastmodifieddate", "datetime", "date"),
    ),
    "products": (
        ("name", "string", "text"),
        ("price", "number", "number"),
        ("hs_sku", "string", "text"),
        ("createdate", "datetime", "date"),
        ("hs_lastmodifieddate", "datetime", "date"),
    ),
}

# RAW table each entity lands in, and the associations read with it.
RAW_TABLES = {
    "companies": "hubspot_companies",
    "contacts": "hubspot_contacts",
    "deals": "hubspot_deals",
    "line_items": "hubspot_line_items",
    "products": "hubspot_products",
}
ENTITY_ASSOCIATIONS = {
    "companies": (),
    "contacts": ("companies",),
    "deals": ("companies",),
    "line_items": ("deals",),
    "products": (),
}

# Freshness limits in hours.
FRESHNESS_WARN_HOURS = 25
FRESHNESS_ERROR_HOURS = 48

# Largest batch the CRM accepts per update call.
EXPORT_BATCH_SIZE = 100


def tracked_names(entity: str) -> tuple[str, ...]:
    return tuple(name for name, _, _ in TRACKED_PROPERTIES[entity])
