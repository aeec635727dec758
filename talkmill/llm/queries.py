"""The llm queries by name, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from talkmill.llm import canonical, dialogues, mixing, names, pii, residue, tokens


def queries() -> dict:
    return {
        "p1_found": dialogues.p1_found,
        "p1_dialogues": dialogues.p1_dialogues,
        "p3_found": pii.p3_found,
        "p3_redacted": pii.p3_redacted,
        "p5_found": canonical.p5_found,
        "p5_values": canonical.p5_values,
        "p6_found": names.p6_found,
        "p6_entities": names.p6_entities,
        "p7_ids": tokens.p7_ids,
        "p8_mix": mixing.p8_mix,
        "p8_report": mixing.p8_report,
        "p9_found": residue.p9_found,
    }


def oracle_sql() -> dict[str, str]:
    return {**dialogues.SQL}
