"""The graph's types and rules."""

from __future__ import annotations

#: Node types, edge types with the types of source and target (empty: any), roles.
NODE_TYPES = ["Person", "Event", "Place", "Phase", "Theme", "Reflection", "Work", "Era"]
EDGE_RULES = {
    "INVOLVES": (["Event"], ["Person"]),
    "LOCATED_AT": (["Event"], ["Place"]),
    "DURING": (["Event"], ["Phase", "Era"]),
    "CREATED": (["Person"], ["Work"]),
    "RELATED_TO": ([], []),
    "EMBODIES": (["Event", "Person"], ["Theme"]),
    "REFLECTS_ON": (["Reflection"], []),
    "ECHOES": (["Event"], ["Event"]),
    "CONTRASTS_WITH": (["Event", "Theme"], ["Event", "Theme"]),
    "TRANSFORMS_INTO": (["Phase", "Person", "Era"], ["Phase", "Person", "Era"]),
    "CAUSED": (["Event"], ["Event"]),
    "FOLLOWS": (["Event", "Era"], ["Event", "Era"]),
    "OCCURS_IN": (["Phase"], ["Era"]),
    "SPECIALIZES": (["Theme"], ["Theme"]),
}
ROLES = ["protagonist", "participant", "mentioned"]
TYPE_RANK = ["Event", "Person", "Place", "Phase", "Era", "Theme", "Reflection", "Work"]
