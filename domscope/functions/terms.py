"""Term and marker lists. Fixed values; every function that uses one takes it as a parameter."""

OPERATOR_TERMS = (
    "sweeps", "social casino", "casino", "sportsbook", "slots", "poker", "sweepstakes game", "fish game", "gold coins",
    "sweeps coins", "sweeps cash", "no purchase necessary", "redeem", "cash prizes",
)
PROMOTER_TERMS = ("best casinos", "top sweeps", "reviews", "promo code", "affiliate", "bonus guide", "comparison")
PROVIDER_TERMS = (
    "game studio", "gaming supplier", "slot studio", " slot provider", "game provider", "studio ", "provider of",
)
PAYMENT_TERMS = ("wallet", "cashier", "deposit", "checkout", "payment", "redemption", "kyc")
WEAK_NOTE_MARKERS = ("not verified", "reported", "403", "inferred", "url pattern", "could not verify", "blocked")
REDIRECT_MARKERS = ("redirect", "rebrand", "formerly ", "previously ", "moved to", "now at")
SENSITIVE_FIELDS = ("parent_company", "cashier_path", "analytics_ids", "support_widget", "provider_mentions")
PLACEHOLDER_DOMAINS = ("example.com", "example.org", "localhost", "invalid", "test")
PLACEHOLDER_FRAGMENTS = ("placeholder", "pending", "unknown", "tbd")
EXCLUDED_DOMAINS = (
    "pending-promoter-01.invalid", "pending-promoter-02.invalid", "pending-payment-01.invalid", "example.com",
    "example.org", "example.net",
)

INFERRED_MARKERS = (
    "not verified", "inferred", "likely ", " likely", "reported ultimate parent", "url pattern",
    "not directly verified", "403", " access denied", "blocked", "cloudflare", "js/", "could not verify",
    "not confirmed", "ambiguous",
)
SECONDARY_MARKERS = (
    "secondary sources", "third-party reporting", "third party reporting", " corroborated", "reported ",
    "per reporting", "news article",
)
FIRST_PARTY_MARKERS = (
    "quoted verbatim", "official site", "official terms", "official provider page", "direct fetch", "first-party",
    "first party", "confirmed on",
)

FIRST, SECONDARY, INFERRED = "first_party_verified", "secondary_corroborated", "inferred_or_unverified"
TIER_RANK = {FIRST: 100, SECONDARY: 50, INFERRED: 10, "inferred": 10, "pending": 5}
TIER_CAP = {FIRST: 0.92, SECONDARY: 0.78, INFERRED: 0.55}
#: Evidence on entity pairs in evidence order: (signal, evidence type, weight).
ENTITY_EVIDENCE = (
    ("legal", "shared_legal_entity", 50),
    ("ids", "shared_analytics_or_tag", 40),
    ("provider", "shared_provider", 20),
    ("provider_edge", "shared_provider", 20),
    ("flow", "shared_cashier_pattern", 15),
    ("script", "shared_script_cdn_or_widget", 10),
    ("promoter", "shared_promoter_cluster", 10),
    ("registrar", "shared_registrar", 5),
    ("nameserver", "shared_nameserver", 5),
)
#: Weights of domain-pair signals.
DOMAIN_WEIGHTS = {
    "tls_san_reciprocal": 15,
    "tls_san_one_way": 7,
    "shared_nameserver_filtered": 5,
    "shared_mx_filtered": 4,
}
LABELS = ((80, "likely_same_network"), (50, "strong_affiliation"), (25, "possible_affiliation"))
WEAKEST_LABEL = "weak_signal"

#: Ids, sources and notes that staged documents carry.
DUPLICATE_ID, DUPLICATE_TYPE = "scout_dup_%04d", "duplicate_alias_candidate"
RESEARCH_ID, RESEARCH_SOURCE = "research_%04d", "research_cluster_corporate"
DUMP_ID, DUMP_SOURCE = "claude_aff_%04d", "claude_affiliations_dump"
CORPORATE_NOTE = ("Cluster key '", "'; verify before treating as production relationship.")
