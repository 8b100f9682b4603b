"""Conditional expressions that label the sender of a message."""

from __future__ import annotations

from chatlake.schema import AGENT_ICON, ROLE_AGENT, ROLE_USER, USER_ICON


def sender_label_sql(
    role: str = "from_role",
    agent_name: str = "bot_conversationtranscriptidname",
    user_name: str = "userfullname",
) -> str:
    """Role 0: the agent's name; role 1: the user's full name; otherwise NULL."""
    return f"CASE `{role}` WHEN {ROLE_AGENT} THEN `{agent_name}` WHEN {ROLE_USER} THEN `{user_name}` END"


def sender_icon_sql(role: str = "from_role") -> str:
    """Role 0: robot, role 1: person, otherwise the empty string."""
    return f"CASE `{role}` WHEN {ROLE_AGENT} THEN '{AGENT_ICON}' WHEN {ROLE_USER} THEN '{USER_ICON}' ELSE '' END"
