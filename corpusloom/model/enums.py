"""Enumerations of the data model and their orderings (fixed values)."""

#: Fixed values.
STATUS = ["candidate", "confirmed", "rejected", "deferred"]
TIERS = ["documented", "reconstructed", "contested", "inspired"]
LAYERS = ["surface", "translated", "scholaria", "original"]
TRACKS = ["propp", "bakhtin", "tmi"]
REVIEW_ACTIONS = ["confirmed", "rejected", "modified_confirmed", "deferred"]
PROPOSAL_STATUS = ["proposed", "confirmed", "revised", "deferred"]
#: Which source of a tradition counts, and how sure its structure is.
SOURCE_PRIORITY = {"tei-xml": 1, "oracc-atf": 1, "txt": 2, "md": 2, "digital-pdf": 3, "scanned-pdf": 4}
STRUCTURE_CONFIDENCE = {"tei-xml": 1.0, "oracc-atf": 1.0, "txt": 0.9, "md": 0.9, "digital-pdf": 0.8, "scanned-pdf": 0.7}

#: Code to profile value.
PROFILE = {
    "BAKHTIN-POLYPHONY-LOW": ("polyphony", 0.2, None),
    "BAKHTIN-POLYPHONY-MEDIUM": ("polyphony", 0.5, None),
    "BAKHTIN-POLYPHONY-HIGH": ("polyphony", 0.9, None),
    "BAKHTIN-CARNIVALESQUE-ABSENT": ("carnivalesque", 0.0, None),
    "BAKHTIN-CARNIVALESQUE-PRESENT": ("carnivalesque", 0.7, None),
    "BAKHTIN-CARNIVALESQUE-DOMINANT": ("carnivalesque", 0.95, None),
    "BAKHTIN-HETEROGLOSSIA-MONOGLOSSIC": ("heteroglossia", None, "monoglossic"),
    "BAKHTIN-HETEROGLOSSIA-HETEROGLOSSIC": ("heteroglossia", None, "heteroglossic"),
    "BAKHTIN-HETEROGLOSSIA-PLURIVALENT": ("heteroglossia", None, "plurivalent"),
}
#: Stems that say a text is damaged.
HEDGES = [
    "lacuna", "lost", "absent", "missing", "not preserved", "broken", "breaks off", "break off", "damaged", "fragmentary", "reconstruct",
    "uncertain", "gap", "survive", "утрач", "отсутств", "лакун", "обрыва", "поврежд", "восстан", "не сохран", "пропущ", "фрагментар",
    "разрушен", "повреждён", "утерян",
]
#: Fixed values.
FLAGS = ["derived_exports", "constellation_candidates", "parallel_detection_pipeline", "sub_episode_extension", "taxonomy_derivation", "layer_3_original", "campbell_track"]


def flags(settings: dict | None = None) -> dict[str, bool]:
    """Feature flags: all off unless set; a value that is no boolean is an error, an unknown flag is off."""
    out = dict.fromkeys(FLAGS, False)
    for k, v in (settings or {}).items():
        if not isinstance(v, bool):
            raise TypeError(f"flag {k} is not a boolean")
        out[k] = v
    return out
