"""Options of reads and writes: names, defaults, session-wide settings, validation."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from propgraph.columns import DEFAULT_LABEL, EDGE, ROOT_CONCEPT, VERTEX

# A session setting `spark.propgraph.<option>` is the default for that option.
CONF_PREFIX = "spark.propgraph."

# Option names.
ELEMENT_TYPE = "element.type"
AUTHORIZATIONS = "authorizations"
FETCH_HINTS = "reader.fetchHints"
CONCEPT_TYPE_OPTION = "conceptType"
LABEL_TYPE_OPTION = "labelType"
PARTITIONING_STRATEGY = "partitioning.strategy"
OPTION_NAMES = (
    ELEMENT_TYPE, AUTHORIZATIONS, FETCH_HINTS,
    CONCEPT_TYPE_OPTION, LABEL_TYPE_OPTION, PARTITIONING_STRATEGY,
)

# Fetch hints, by whether property values are fetched.
HINTS_WITH_PROPERTIES = (
    "ALL", "PROPERTIES", "PROPERTIES_AND_METADATA",
    "PROPERTIES_AND_EDGE_REFS", "ALL_INCLUDING_HIDDEN",
)
HINTS_WITHOUT_PROPERTIES = ("EDGE_LABELS", "EDGE_REFS", "NONE")
HINT_WITH_HIDDEN = "ALL_INCLUDING_HIDDEN"

STRATEGIES = ("none", "shard", "range")


def require_choice(value: str, choices: Collection[str], name: str) -> None:
    if value not in choices:
        raise ValueError(f"Parameter '{name}' must be one of {', '.join(choices)}, not '{value}'")


@dataclass(frozen=True)
class GraphOptions:
    """Checked options of one read or write."""

    element_type: str
    authorizations: tuple[str, ...] = ()
    fetch_hints: str = "ALL"
    concept_type: str = ROOT_CONCEPT
    label_type: str = DEFAULT_LABEL
    partitioning: str = "shard"

    def __post_init__(self) -> None:
        require_choice(self.element_type, (VERTEX, EDGE), ELEMENT_TYPE)
        require_choice(self.fetch_hints, HINTS_WITH_PROPERTIES + HINTS_WITHOUT_PROPERTIES, FETCH_HINTS)
        require_choice(self.partitioning, STRATEGIES, PARTITIONING_STRATEGY)
        for value, name in ((self.concept_type, CONCEPT_TYPE_OPTION), (self.label_type, LABEL_TYPE_OPTION)):
            if not value.strip():
                raise ValueError(f"Parameter '{name}' is required")  # fixed value: the message

    @property
    def default_type(self) -> str:
        return self.concept_type if self.element_type == VERTEX else self.label_type

    @classmethod
    def resolve(cls, spark: SparkSession, options: Mapping[str, str]) -> GraphOptions:
        """Explicit options first, then the session's settings, then the defaults.

        An empty value counts as missing. `authorizations` is one token: it is not split.
        """
        unknown = sorted(set(options) - set(OPTION_NAMES))
        if unknown:
            raise ValueError(f"Unknown options: {', '.join(unknown)}")

        def setting(name: str) -> str:
            return options.get(name) or spark.conf.get(CONF_PREFIX + name, "") or ""

        def optional(name: str, default: str) -> str:
            return setting(name).strip() or default

        element_type = setting(ELEMENT_TYPE)
        if not element_type:
            raise ValueError(f"Parameter '{ELEMENT_TYPE}' is required")  # fixed value: the message
        token = optional(AUTHORIZATIONS, "")
        return cls(
            element_type=element_type,
            authorizations=(token,) if token else (),
            fetch_hints=optional(FETCH_HINTS, "ALL"),
            concept_type=optional(CONCEPT_TYPE_OPTION, ROOT_CONCEPT),
            label_type=optional(LABEL_TYPE_OPTION, DEFAULT_LABEL),
            partitioning=optional(PARTITIONING_STRATEGY, "shard"),
        )
