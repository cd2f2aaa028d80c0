"""The built-in field groups over a request log, and the default set of all of them."""

from __future__ import annotations

from logtables.spec import Exporter, FieldSet, FieldSpec


def _group(name: str, *fields: tuple[str, str, str]) -> Exporter:
    return Exporter(name, tuple(FieldSpec(n, t, e) for n, t, e in fields))


# Output names, types and order are fixed values.

HTTP = _group(
    "http",
    ("httpStatus", "integer", "http_status"),
    ("method", "string", "method"),
    ("httpVersion", "string", "http_version"),
    ("requestId", "string", "request_id"),
)

INSTANCE = _group("instance", ("instanceKey", "string", "instance_key"))

PERFORMANCE = _group(
    "performance",
    ("cost", "float", "cost"),
    ("responseSize", "integer", "response_size"),
    ("mcycles", "integer", "mcycles"),
    ("loadingRequest", "boolean", "loading_request"),
    ("pendingTimeUsec", "integer", "pending_time_usec"),
    ("latencyUsec", "integer", "latency_usec"),
)

TIMESTAMP = _group("timestamp", ("timestamp", "integer", "start_time_usec"))

URL = _group(
    "url",
    ("host", "string", "host"),
    # Everything before the first question mark; a fragment stays.
    ("path", "string", "substring_index(resource, '?', 1)"),
    ("resource", "string", "resource"),
)

USER = _group(
    "user",
    ("nickname", "string", "nickname"),
    ("ip", "string", "ip"),
    ("userAgent", "string", "user_agent"),
)

VERSION = _group(
    "version",
    ("versionId", "string", "version_id"),
    ("moduleId", "string", "module_id"),
)

BASIC = FieldSet((HTTP, INSTANCE, PERFORMANCE, TIMESTAMP, URL, USER, VERSION))

