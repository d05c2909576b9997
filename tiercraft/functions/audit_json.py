"""Reading the audit payload, a JSON text with optional and sometimes malformed parts.

The payload is parsed once into its scalar fields. Array fields are kept as JSON text by that pass and parsed
into typed arrays afterwards, so one malformed array becomes NULL without losing its siblings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names inside the payload.
EVENT_FIELDS = (
    "AppHost",
    "TargetAgentName",
    "LicenseType",
    "ConversationId",
    "ThreadId",
    "Messages",
    "AISystemPlugin",
    "AccessedResources",
)
ROOT_FIELDS = ("AppIdentity", "ApplicationName", "AgentName", "CopilotLogVersion")
EVENT = "CopilotEventData"
FIRST_MODEL = f"$.{EVENT}.ModelTransparencyDetails[0]"
WEB_SEARCH_PLUGIN = "BingWebSearch"

PAYLOAD_TYPE = (
    ", ".join(f"{name} string" for name in ROOT_FIELDS)
    + f", {EVENT} struct<{', '.join(f'{name}: string' for name in EVENT_FIELDS)}>"
)
MESSAGES_TYPE = "array<struct<isPrompt: boolean, JailbreakDetected: boolean>>"
PLUGINS_TYPE = "array<struct<Id: string>>"
RESOURCES_TYPE = "array<string>"


def payload(text: Column) -> Column:
    """The payload as a struct of texts."""
    return F.from_json(text.cast("string"), PAYLOAD_TYPE)


def event_field(parsed: Column, name: str) -> Column:
    return parsed.getField(EVENT).getField(name)


def first_model_field(text: Column, name: str) -> Column:
    """A field of the first model entry; NULL unless the entries form an array."""
    return F.get_json_object(text.cast("string"), f"{FIRST_MODEL}.{name}")


def messages(parsed: Column) -> Column:
    return F.from_json(event_field(parsed, "Messages"), MESSAGES_TYPE)


def plugins(parsed: Column) -> Column:
    return F.from_json(event_field(parsed, "AISystemPlugin"), PLUGINS_TYPE)


def resources(parsed: Column) -> Column:
    return F.from_json(event_field(parsed, "AccessedResources"), RESOURCES_TYPE)


def size_or_zero(items: Column) -> Column:
    return F.coalesce(F.array_size(items), F.lit(0))


def prompt_count(items: Column) -> Column:
    return size_or_zero(F.filter(items, lambda message: message["isPrompt"]))


def any_jailbreak(items: Column) -> Column:
    return F.coalesce(F.exists(items, lambda message: message["JailbreakDetected"]), F.lit(False))


def any_web_search(items: Column) -> Column:
    return F.coalesce(F.exists(items, lambda plugin: plugin["Id"] == WEB_SEARCH_PLUGIN), F.lit(False))
