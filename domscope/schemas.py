"""Explicit schemas. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _A = T.StringType(), T.ArrayType(T.StringType())


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


ATTRIBUTES = _struct(
    legal_entity=_S,
    jurisdictions=_A,
    blockable=T.BooleanType(),
    evidence_only=T.BooleanType(),
    provider_names=_A,
    promoter_type=_S,
    promotes_categories=_A,
    provider_type=_S,
    domains_pending_verification=T.BooleanType(),
    payment_type=_S,
    domain_or_pattern=_S,
    path_patterns=_A,
    parent_company=_S,
    company_number=_S,
)
ENTITY = _struct(
    id=_S,
    name=_S,
    entity_type=_S,
    domains=_A,
    categories=_A,
    status=_S,
    confidence=T.DoubleType(),
    sources=_A,
    notes=_S,
    first_seen=_S,
    last_seen=_S,
    attributes=ATTRIBUTES,
    ordinal=T.LongType(),
)
EDGE = _struct(
    from_id=_S,
    to_id=_S,
    relationship=_S,
    confidence=T.DoubleType(),
    source=_S,
    evidence=_struct(url=_S, anchor_text=_S),
    ordinal=T.LongType(),
)

TECHNICAL = (
    "nameservers", "ssl_issuers", "analytics_ids", "tag_manager_ids", "script_domains", "iframe_domains",
    "asset_domains", "support_widget_providers",
)
CONTENT = ("legal_entity_names", "footer_phrases", "title_terms", "bonus_terms", "provider_mentions")
FLOW = ("signup_paths", "cashier_paths", "redemption_paths", "kyc_vendors", "payment_providers")
PROVIDER_SIGNALS = ("provider_names", "game_launcher_patterns", "cdn_patterns")
GROUPS = {"technical": TECHNICAL, "content": CONTENT, "flow": FLOW, "provider_signals": PROVIDER_SIGNALS}
#: Leaves that a partial table or a page can fill.
FILLED = {"technical": TECHNICAL[2:], "content": CONTENT, "flow": FLOW, "provider_signals": PROVIDER_SIGNALS}
FINGERPRINT = _struct(
    entity_id=_S,
    technical=_struct(registrar=_S, **dict.fromkeys(TECHNICAL, _A)),
    content=_struct(**dict.fromkeys(CONTENT, _A)),
    flow=_struct(**dict.fromkeys(FLOW, _A)),
    provider_signals=_struct(**dict.fromkeys(PROVIDER_SIGNALS, _A)),
)

MX = T.ArrayType(_struct(host=_S, priority=T.IntegerType()))
DOMAIN_FINGERPRINT = _struct(
    domain=_S,
    sans=_A,
    nameservers=_A,
    mx=MX,
    tls_partial=T.BooleanType(),
    dns_partial=T.BooleanType(),
)
CLUSTER_EVIDENCE = T.ArrayType(_struct(domains=_A, reason=_S, detail=_S))


def lowered_leaf(group: str, leaf: str, from_page: bool = False) -> bool:
    """Whether merging lowers the values of a leaf: hosts, widgets and ids, all of flow, and title terms of pages."""
    return group == "flow" or group == "technical" or from_page and leaf == "title_terms"


def filled(struct: T.StructType, values: dict[str, Column]) -> Column:
    """A struct of the given type; members without a value are null."""
    return F.struct(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in struct.fields))
