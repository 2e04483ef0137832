"""Which role a session played: from its folder, else from its first user text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.fixed import CWD_ROLES, FOLDER_ROLES, ROLE_BANNER, ROLES
from ..functions.text import first_match


def role_from_folder(folder: Column) -> Column:
    """Null if no rule matches."""
    return first_match(folder, FOLDER_ROLES)


def role_from_cwd(cwd: Column) -> Column:
    """From a working directory, for transcripts that name it; null if no rule matches."""
    return first_match(cwd, CWD_ROLES)


def role_from_text(text: Column, banner: str = ROLE_BANNER) -> Column:
    """The role that a banner in the text names; null if none or unknown. ``banner`` is a pattern; by default any in upper case."""
    named = F.lower(F.regexp_extract(text, rf"(?U)\[{banner}\]\s+(\w+)\s+<-", 1))
    return F.when(named.isin(*ROLES), named)


def tag_role(folder: Column, first_user_text: Column, banner: str = ROLE_BANNER) -> Column:
    return F.coalesce(role_from_folder(folder), role_from_text(first_user_text, banner), F.lit("unknown"))


def folder_suffix_role(folder: Column, prefix: str) -> Column:
    """The raw folder name after a prefix; not one of the fixed roles."""
    return F.regexp_replace(folder, "^\\Q" + prefix + "\\E", "")


def first_user_text(turns: Column) -> Column:
    """Content of the first user turn, empty if there is none."""
    return F.coalesce(F.try_element_at(F.filter(turns, lambda t: t.role == "user"), F.lit(1)).content, F.lit(""))
