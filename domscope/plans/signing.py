"""Signed documents: canonical JSON, SHA-256, Ed25519 by the JVM, and a store of trusted keys.

Documents are small and live on the driver. The JVM of the session does the cryptography.
"""

from __future__ import annotations

import base64
import hashlib
import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

ALGORITHM = "ed25519"
log = logging.getLogger(__name__)


class SigningError(Exception):
    """Signing failed."""


class SigningKeyError(SigningError):
    """The private key can't be used."""


class CanonicalizationError(SigningError):
    """The payload has no canonical form."""


class VerificationError(Exception):
    """Verification failed."""


class VerificationKeyError(VerificationError):
    """The public key can't be used."""


class TrustStoreError(VerificationKeyError):
    """The trust store is malformed."""


class SignatureVerificationError(VerificationError):
    """The signature does not hold."""


class HashMismatchError(SignatureVerificationError):
    """The payload is not what was signed."""


class EnvelopeShapeError(SignatureVerificationError):
    """The document is no envelope."""


class UntrustedKeyError(SignatureVerificationError):
    """Nobody trusts the key."""


class RevokedKeyError(SignatureVerificationError):
    """The key was revoked."""


class UnauthorizedArtifactError(SignatureVerificationError):
    """The key may not sign this kind of artifact."""


def canonical_bytes(payload: Any) -> bytes:
    try:
        return json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=True, allow_nan=False).encode()
    except (TypeError, ValueError) as e:
        raise CanonicalizationError(str(e)) from e


def payload_hash(payload: Any) -> str:
    return hashlib.sha256(canonical_bytes(payload)).hexdigest()


def from_base64url(value: str) -> bytes:
    """With or without padding."""
    return base64.urlsafe_b64decode(value + "=" * (-len(value) % 4))


def _body(pem: str, kind: str) -> bytes:
    head, tail = f"-----BEGIN {kind}-----", f"-----END {kind}-----"
    if head not in pem or tail not in pem:
        raise ValueError(f"no {kind}")
    return base64.b64decode("".join(pem.split(head, 1)[1].split(tail, 1)[0].split()), validate=True)


def _pem(kind: str, der: bytes) -> str:
    text = base64.b64encode(der).decode()
    return "\n".join(
        [f"-----BEGIN {kind}-----", *(text[k : k + 64] for k in range(0, len(text), 64)), f"-----END {kind}-----", ""]
    )


class Keys:
    """Ed25519 through java.security of a session."""

    def __init__(self, spark):
        self.jvm = spark._jvm

    def _key(self, pem: str, private: bool):
        try:
            if private:
                spec = self.jvm.java.security.spec.PKCS8EncodedKeySpec(_body(pem, "PRIVATE KEY"))
                return self.jvm.java.security.KeyFactory.getInstance("Ed25519").generatePrivate(spec)
            spec = self.jvm.java.security.spec.X509EncodedKeySpec(_body(pem, "PUBLIC KEY"))
            return self.jvm.java.security.KeyFactory.getInstance("Ed25519").generatePublic(spec)
        except Exception as e:
            raise (SigningKeyError if private else VerificationKeyError)(str(e).splitlines()[0]) from e

    def generate(self) -> tuple[str, str]:
        """(private PEM, public PEM)."""
        pair = self.jvm.java.security.KeyPairGenerator.getInstance("Ed25519").generateKeyPair()
        # The key classes themselves are hidden from reflection; their specs are not.
        factory = self.jvm.java.security.KeyFactory.getInstance("Ed25519")
        spec = lambda name: self.jvm.java.lang.Class.forName(f"java.security.spec.{name}EncodedKeySpec")
        private, public = factory.getKeySpec(
            pair.getPrivate(), spec("PKCS8"),
        ), factory.getKeySpec(pair.getPublic(), spec("X509"))
        return _pem("PRIVATE KEY", bytes(private.getEncoded())), _pem("PUBLIC KEY", bytes(public.getEncoded()))

    def sign(self, data: bytes, private_pem: str) -> bytes:
        s = self.jvm.java.security.Signature.getInstance("Ed25519")
        s.initSign(self._key(private_pem, True))
        s.update(data)
        return bytes(s.sign())

    def holds(self, data: bytes, signature: bytes, public_pem: str) -> bool:
        key = self._key(public_pem, False)
        s = self.jvm.java.security.Signature.getInstance("Ed25519")
        s.initVerify(key)
        s.update(data)
        try:
            return bool(s.verify(signature))
        except Exception:  # noqa: BLE001  a malformed signature
            return False


@dataclass(frozen=True)
class TrustedKey:
    key_id: str
    algorithm: str
    public_key_pem: str
    issued_at: str
    authorized_for: tuple[str, ...]
    revoked_at: str | None = None
    revocation_reason: str | None = None

    @property
    def revoked(self) -> bool:
        return self.revoked_at is not None


@dataclass(frozen=True)
class TrustStore:
    schema_version: int
    updated_at: str
    keys: tuple[TrustedKey, ...] = field(default=())

    def get(self, key_id: str) -> TrustedKey | None:
        return next((k for k in self.keys if k.key_id == key_id), None)

    @classmethod
    def parse(cls, doc: Any) -> TrustStore:
        def need(value, kind, name):
            if not isinstance(value, kind) or isinstance(value, bool):
                raise TrustStoreError(f"{name} is missing or of the wrong type")
            return value

        doc = need(doc, dict, "trust store")
        keys = []
        for k in need(doc.get("keys"), list, "keys"):
            k = need(k, dict, "key")
            kinds = need(k.get("authorized_for"), list, "authorized_for")
            rest = {n: need(k[n], str, n) for n in ("revoked_at", "revocation_reason") if k.get(n) is not None}
            keys.append(
                TrustedKey(
                    *(need(k.get(n), str, n) for n in ("key_id", "algorithm", "public_key_pem", "issued_at")),
                    tuple(need(x, str, "authorized_for") for x in kinds),
                    **rest,
                )
            )
        return cls(
            need(doc.get("schema_version"), int, "schema_version"),
            need(doc.get("updated_at"), str, "updated_at"),
            tuple(keys),
        )


def sign_envelope(
    keys: Keys, payload: Mapping[str, Any], private_pem: str, key_id: str, signed_at: str,
) -> dict[str, Any]:
    data = canonical_bytes(payload)
    seal = base64.urlsafe_b64encode(keys.sign(data, private_pem)).decode().rstrip("=")
    return {
        "payload": payload,
        "signature": {
            "algorithm": ALGORITHM,
            "key_id": key_id,
            "signed_at": signed_at,
            "payload_hash_sha256": hashlib.sha256(data).hexdigest(),
            "signature_b64": seal,
        },
    }


def is_envelope(doc: Any) -> bool:
    return isinstance(doc, dict) and isinstance(doc.get("payload"), dict) and isinstance(doc.get("signature"), dict)


def verify_envelope(keys: Keys, envelope: Any, store: TrustStore, artifact: str) -> dict[str, Any]:
    """The payload, if the envelope is whole and its key is known, trusted, not revoked and authorised."""
    if not is_envelope(envelope):
        raise EnvelopeShapeError("payload and signature must be objects")
    seal = envelope["signature"]
    for name in ("algorithm", "key_id", "payload_hash_sha256", "signature_b64"):
        if not isinstance(seal.get(name), str):
            raise EnvelopeShapeError(f"signature has no {name}")
    if seal["algorithm"] != ALGORITHM:
        raise EnvelopeShapeError(f"unknown algorithm {seal['algorithm']!r}")
    trusted = store.get(seal["key_id"])
    if trusted is None:
        raise UntrustedKeyError(seal["key_id"])
    if trusted.revoked:
        raise RevokedKeyError(seal["key_id"])
    if artifact not in trusted.authorized_for:
        raise UnauthorizedArtifactError(artifact)
    if payload_hash(envelope["payload"]) != seal["payload_hash_sha256"]:
        raise HashMismatchError(seal["key_id"])
    try:
        raw = from_base64url(seal["signature_b64"])
    except ValueError as e:
        raise EnvelopeShapeError("signature_b64") from e
    if not keys.holds(canonical_bytes(envelope["payload"]), raw, trusted.public_key_pem):
        raise SignatureVerificationError(seal["key_id"])
    return envelope["payload"]


def opened(
    keys: Keys,
    doc: Any,
    *,
    store: TrustStore | None,
    artifact: str,
    require_signed: bool = False,
    expected_key_id: str | None = None,
) -> Any:
    """The payload of a signed document, or an unsigned document itself unless a signature is required.

    A signature that can't be checked, because there is no trust store, is no signature where one is required.
    """
    if not is_envelope(doc):
        if require_signed:
            raise EnvelopeShapeError("a signed document is required")
        return doc
    if expected_key_id is not None and doc["signature"].get("key_id") != expected_key_id:
        raise UntrustedKeyError(str(doc["signature"].get("key_id")))
    if store is None:
        if require_signed:
            raise VerificationKeyError("a signed document is required, but there is no trust store")
        return doc["payload"]
    return verify_envelope(keys, doc, store, artifact)


def read_pem(path: str | Path, *, private: bool = False) -> str:
    """The text of a key file. A file that is missing, unreadable or of another kind is a key error."""
    error, kind = (SigningKeyError, "PRIVATE KEY") if private else (VerificationKeyError, "PUBLIC KEY")
    try:
        text = Path(path).read_text(encoding="utf-8")
    except (OSError, UnicodeDecodeError) as e:
        raise error(f"cannot read {path}: {e}") from e
    if f"-----BEGIN {kind}-----" not in text or f"-----END {kind}-----" not in text:
        raise error(f"{path} holds no {kind.lower()}")
    return text


def load_trust_store(path: str | Path) -> TrustStore:
    """A missing, unreadable or malformed file is a TrustStoreError."""
    try:
        doc = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise TrustStoreError(f"cannot read the trust store {path}: {e}") from e
    return TrustStore.parse(doc)


def fingerprint_map(
    keys: Keys,
    path: str | Path,
    *,
    store: TrustStore | None = None,
    require_signed: bool = False,
    expected_key_id: str = "scout-fingerprint-key-v1",
) -> dict[str, Any]:
    """{domain: record} of a file: a plain object, or the fingerprints in the payload of a signed one.

    A file that is missing, unreadable or no JSON object is an empty map with a warning; a signature that
    does not hold, or is missing where one is required, is an error.
    """
    try:
        doc = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        log.warning("no fingerprints in %s: %s", path, e)
        return {}
    if not isinstance(doc, dict):
        log.warning("no fingerprints in %s: not an object", path)
        return {}
    if not is_envelope(doc):
        return opened(keys, doc, store=store, artifact="domain_fingerprints", require_signed=require_signed)
    ident = doc["signature"].get("key_id")
    if not isinstance(ident, str) or not ident.strip():
        raise EnvelopeShapeError("signature has no key_id")
    if ident != expected_key_id:
        raise SignatureVerificationError(f"signed by {ident!r}, not by {expected_key_id!r}")
    if store is None:
        log.warning("%s is signed, but there is no trust store: its signature is not checked", path)
    payload = opened(keys, doc, store=store, artifact="domain_fingerprints", require_signed=require_signed)
    found = payload.get("fingerprints")
    return found if isinstance(found, dict) else {}


def trust_entry(path: str | Path, key_id: str, authorized_for: Sequence[str], issued_at: str) -> dict[str, Any]:
    """The entry of a public key file for a trust store."""
    return {
        "key_id": key_id,
        "algorithm": ALGORITHM,
        "public_key_pem": read_pem(path),
        "issued_at": issued_at,
        "authorized_for": list(authorized_for),
        "revoked_at": None,
        "revocation_reason": None,
    }
