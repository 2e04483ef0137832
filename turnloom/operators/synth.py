"""Synthetic patrol samples from weighted templates: which template, names and faults a row gets follows a hash of seed and row number."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import SECTIONS
from ..functions.text import hash_uniform
from .snapshot import format_snapshot

SYSTEM = "You watch over workers. Answer with one decision as a JSON object with tool and args."
NAMES = {
    "rig": ("north", "harbour", "mill", "quarry"), "worker": ("amber", "birch", "cedar", "dune", "ember"), "item": ("it-101", "it-202", "it-303", "it-404"),
    "mail": ("m-7k", "m-2p", "m-9x"), "branch": ("fix/parser", "feat/export", "docs/readme"), "minutes": ("12", "25", "47", "90"),
}
QUIET = {"Polecats": "No workers.", "Inbox": "No unread messages.", "Cleanup Wisps": "None", "Infrastructure": "All services run.", "Active Work": "None", "State": "patrol_count: 4, idle_cycles: 1"}
FAULT, FAULTY = "[error] command timed out", "Inbox"
#: name, kind, weight, tool, arguments, and the user's text (legacy) or the sections that differ from QUIET (rich)
TEMPLATES = (
    ("all_idle", "legacy", 3.0, "none", {}, "Nothing waits on {rig}; no worker is busy."), ("healthy_worker", "legacy", 3.0, "none", {}, "{worker} on {rig} wrote output a minute ago and works on {item}."),
    ("stuck_worker", "legacy", 2.0, "gt_nudge", {"target": "{rig}/{worker}"}, "{worker} on {rig} has been silent for {minutes} minutes with {item} open."),
    ("finished_work", "legacy", 2.0, "bd_close", {"id": "{item}"}, "{item} on {rig} is merged from {branch}, but still open."),
    ("crash_loop", "legacy", 2.5, "gt_escalate", {"topic": "{rig}/{worker} restarts"}, "{worker} on {rig} has restarted five times in {minutes} minutes."),
    ("unpushed_work", "legacy", 2.5, "check_git_state", {"target": "{rig}/{worker}"}, "{worker} on {rig} stopped; {branch} has commits that are not pushed."),
    ("look_at_services", "legacy", 1.5, "gt_session_status", {"rig": "{rig}"}, "No one has looked at the services of {rig} for {minutes} minutes."),
    ("new_mail", "legacy", 1.0, "gt_mail_inbox", {}, "The mail of {rig} was last read {minutes} minutes ago."),
    ("quiet_round", "rich", 3.0, "none", {}, {}), ("busy_round", "rich", 3.0, "none", {}, {"Polecats": "{rig}/{worker} working, output a minute ago", "Active Work": "{item} in progress"}),
    ("silent_worker", "rich", 2.0, "gt_nudge", {"target": "{rig}/{worker}"}, {"Polecats": "{rig}/{worker} working, silent for {minutes} minutes", "Active Work": "{item} in progress"}),
    ("done_mail", "rich", 2.5, "gt_mail_send", {"to": "{rig}/merger", "about": "{item}"}, {"Inbox": "{mail} from {rig}/{worker}: {item} is done, {branch} is pushed"}),
    ("shutdown_mail", "rich", 2.0, "gt_polecat_nuke", {"target": "{rig}/{worker}"}, {"Inbox": "{mail} from {rig}: {worker} may go", "Polecats": "{rig}/{worker} done"}),
    ("merged_mail", "rich", 2.0, "bd_close", {"id": "{item}"}, {"Inbox": "{mail} from {rig}/merger: {branch} for {item} is merged"}),
    ("help_mail", "rich", 2.5, "gt_escalate", {"topic": "{item}"}, {"Inbox": "{mail} from {rig}/{worker}: I need help with {item}"}),
    ("dead_worker", "rich", 2.5, "check_tmux_session", {"session": "{rig}-{worker}"}, {"Polecats": "{rig}/{worker} working, no session", "Active Work": "{item} in progress"}),
    ("stale_start", "rich", 2.0, "gt_peek", {"target": "{rig}/{worker}"}, {"Polecats": "{rig}/{worker} started {minutes} minutes ago, no output"}),
    ("item_without_worker", "rich", 2.0, "bd_show", {"id": "{item}"}, {"Active Work": "{item} in progress, no worker"}),
    ("service_down", "rich", 2.5, "gt_session_status", {"rig": "{rig}"}, {"Infrastructure": "merger of {rig}: not running"}),
    ("several_things", "rich", 2.0, "gt_escalate", {"topic": "{rig}"}, {"Polecats": "{rig}/{worker} no session", "Inbox": "{mail}: help with {item}", "Infrastructure": "merger of {rig}: not running"}),
)


def chosen(mode: str) -> list[tuple]:
    """The templates of a mode (legacy, rich or both)."""
    return [t for t in TEMPLATES if mode in ("both", t[1])]


def uniform(seed: int, stream: str) -> Column:
    return hash_uniform(F.lit(seed), F.lit(stream), F.col("id"))


def _filled(template: str, names: dict[str, Column]) -> Column:
    out = F.lit(template)
    for name, value in names.items():
        if "{" + name + "}" in template:
            out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def generate(spark: SparkSession, n: int, mode: str = "both", seed: int = 42, corrupted: float = 0.1) -> DataFrame:
    """id, template, tool, corrupted, prompt (the user's text, or a snapshot) and answer (the decision as JSON).

    In a corrupted row one section, or the text of a legacy one, is a timeout's message; the decision stays.
    """
    some, names = chosen(mode), {k: F.get(F.array(*map(F.lit, v)), F.floor(uniform(seed, k) * len(v)).cast("int")) for k, v in NAMES.items()}
    total, so_far, u = sum(t[2] for t in some), 0.0, F.col("_u")
    bounds = []
    for t in some:
        so_far += t[2]
        bounds.append(so_far)
    number = F.lit(len(some) - 1)
    for k, bound in reversed(list(enumerate(bounds))[:-1]):
        number = F.when(u * total < bound, k).otherwise(number)
    rows = spark.range(n).withColumns({"_u": uniform(seed, "template"), "corrupted": uniform(seed, "fault") < corrupted, **{f"_{k}": v for k, v in names.items()}}).withColumn("_k", number)
    held = {k: F.col(f"_{k}") for k in NAMES}

    def prompt(text: str | dict[str, str]) -> Column:
        if isinstance(text, str):
            return F.when(F.col("corrupted"), FAULT).otherwise(_filled(text, held))
        parts = [x for name, _ in SECTIONS for x in (F.lit(name), F.when(F.col("corrupted") & F.lit(name == FAULTY), FAULT).otherwise(_filled((QUIET | text)[name], held)))]
        return format_snapshot(F.create_map(*parts))

    def case(of) -> Column:
        out = of(some[-1])
        for k, t in reversed(list(enumerate(some))[:-1]):
            out = F.when(F.col("_k") == k, of(t)).otherwise(out)
        return out

    answer = case(lambda t: _filled(json.dumps({"tool": t[3], "args": t[4]}), held))
    return rows.select("id", case(lambda t: F.lit(t[0])).alias("template"), case(lambda t: F.lit(t[3])).alias("tool"), "corrupted", case(lambda t: prompt(t[5])).alias("prompt"), answer.alias("answer"))


def samples(made: DataFrame, system: str = SYSTEM) -> DataFrame:
    """conversations of three messages from generated rows."""
    say = lambda side, value: F.struct(F.lit(side).alias("from"), value.alias("value"))
    return made.select("id", F.array(say("system", F.lit(system)), say("human", F.col("prompt")), say("gpt", F.col("answer"))).alias("conversations"))


def tool_distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy("tool").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tool")
