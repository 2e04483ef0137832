"""Fixed values that results depend on: patterns, word lists, limits, vocabularies, in one place and in natural order."""

from __future__ import annotations

# Roles, and what names them in a folder (the first that matches counts)
ROLES = ("mayor", "deacon", "boot", "witness", "refinery", "polecat", "crew")
FOLDER_ROLES = (
    (r"-deacon-dogs-boot$", "boot"),
    (r"-deacon-dogs-", "deacon"),
    (r"-deacon$", "deacon"),
    (r"-mayor$", "mayor"),
    (r"-witness$", "witness"),
    (r"-refinery-", "refinery"),
    (r"-crew-", "crew"),
    (r"-polecats-", "polecat"),
)
#: "[BANNER] role <- sender" at any place of the first user text; which banner is a parameter
ROLE_BANNER = r"[A-Z][A-Z ]*"
CWD_ROLES = (
    (r"/deacon$", "deacon"),
    (r"/deacon/dogs/boot$", "boot"),
    (r"/witness$", "witness"),
    (r"/refinery/rig$", "refinery"),
    (r"/mayor/rig$", "mayor"),
    (r"/crew/\w+$", "crew"),
    (r"/polecats/\w+", "polecat"),
)

# Turns of little signal, and the least a sample must hold
BOILERPLATE = (r"(?i)^Mayor,?\s+checking in\.?$", r"(?i)^Let me check.*(hook|mail)", r"(?i)^Nothing on hook", r"(?i)^No .* messages")
MIN_TURNS, MIN_SUBSTANTIVE, MIN_CHARS = 2, 2, 200

# Tool results
NOISE_LINES = (r"^Shell cwd was reset to", r"^WARNING: This binary was built with")
RESULT_CHARS, RESULT_MARK, RESULT_MARK_ROOM = 2000, "\n... [truncated] ...\n", 20

RESULT_BLOCK = r"(?s)(<tool_result[^>]*>)\n(.*?)\n</tool_result>"

# Windows of turns
WINDOW, STRIDE, WINDOW_CHARS = 16, 8, 16384

# Outcome scores
ARTIFACT_WORDS = ("created", "generated", "produced", "wrote", "implemented")
ESCALATION_WORDS = ("escalate", "help", "stuck", "blocked", "witness", "mayor")
MEDIAN_MS = {"polecat": 300_000, "witness": 600_000, "deacon": 900_000, "mayor": 1_200_000, "refinery": 600_000, "crew": 300_000}
TARGET_TURNS = {"polecat": 10, "witness": 15, "deacon": 20, "mayor": 25, "refinery": 15, "crew": 10}
DEFAULT_MEDIAN_MS, DEFAULT_TARGET_TURNS = 600_000, 15
WEIGHTS = (0.3, 0.4, 0.3)

# Commands that a role should use (any one of them)
REQUIRED_COMMANDS = {
    "polecat": ("gt hook", "bd mol current", "gt done"),
    "mayor": ("gt mail inbox", "gt mail send", "bd ready"),
    "deacon": ("gt hook", "bd ready"),
    "witness": ("gt hook", "bd ready"),
    "refinery": ("gt hook",),
    "crew": ("gt hook", "bd mol current"),
}
SUSPICIOUS_COMMANDS = ("gt tool", "gt run", "bd exec", "bd shell")

# Commands in a text; gt and bd take words, git words with hyphens
GT_COMMAND, BD_COMMAND, GIT_COMMAND = r"gt\s+\w+(?:\s+\w+)*", r"bd\s+\w+(?:\s+\w+)*", r"git\s+\w+(?:\s+[\w\-]+)*"
WHOLE_COMMANDS = ("gt mail", "gt mol", "gt handoff")

# Workflows and faults found in a text
WORKFLOWS = (
    ("polecat_startup", r"gt\s+(prime|hook).*bd\s+mol\s+current"),
    ("polecat_completion", r"git\s+(status|add|commit|push).*gt\s+done"),
    ("mail_workflow", r"gt\s+mail\s+(inbox|read|send)"),
    ("bead_lifecycle", r"bd\s+(show|update|close)"),
    ("git_commit_cycle", r"git\s+status.*git\s+add.*git\s+commit.*git\s+push"),
    ("escalation", r"gt\s+(escalate|mail\s+send.*(?:witness|mayor))"),
    ("molecule_workflow", r"bd\s+mol\s+current.*bd\s+close"),
)
ANTI_PATTERNS = (
    ("wrong_git_workflow", r"git\s+push\s+origin\s+main"),
    ("bd_close_root", r"bd\s+close.*root"),
    ("waiting_for_approval", r"(wait.*approval|waiting.*human|ask.*confirmation)"),
    ("wrong_done_command", r"gt\s+(unsling|exit|quit)"),
)
COVERAGE = (
    ("polecat_complete", ("gt hook", "bd mol current", "gt done")),
    ("mail_workflow", ("gt mail inbox", "gt mail read", "gt mail send")),
    ("bead_lifecycle", ("bd show", "bd update", "bd close")),
    ("git_cycle", ("git status", "git add", "git commit", "git push")),
    ("escalation", ("gt escalate", "gt mail send")),
)

# Snapshots of a patrol
SECTIONS = (("Polecats", 800), ("Inbox", 1200), ("Cleanup Wisps", 400), ("Infrastructure", 200), ("Active Work", 600), ("State", 200))
SECTION_LIMIT, SECTION_MARK = 400, "\n[... truncated]"
GATHER_COMMANDS = (
    "gt polecat list", "gt mail inbox", "gt mail read", "bd list", "bd show", "bd children", "bd gate check", "bd mol current", "cat state.json",
    "tmux has-session", "tmux list-sessions", "gt session status", "gt status", "gt peek", "check_git_state", "git status", "git log", "gt hook",
)
ACTION_COMMANDS = ("gt nudge", "gt polecat nuke", "gt mail send", "gt escalate", "gt patrol report", "gt patrol new", "gt handoff", "bd close", "bd mol squash")
COMMAND_SECTIONS = (
    (("gt polecat list", "gt peek"), "Polecats"),
    (("gt mail inbox", "gt mail read"), "Inbox"),
    (("bd list", "bd show", "bd children", "bd mol", "bd gate check"), "Active Work"),
    (("tmux has-session", "tmux list-sessions", "gt session status", "gt status"), "Infrastructure"),
    (("cat state.json",), "State"),
    (("git status", "git log", "check_git_state"), "Active Work"),
    (("gt hook",), "Infrastructure"),
)

# Tools that a decision may name
TOOLS = (
    "gt_polecat_list", "gt_polecat_nuke", "gt_peek", "gt_session_status", "gt_nudge", "gt_mail_inbox", "gt_mail_read", "gt_mail_send", "gt_patrol_report",
    "gt_handoff", "gt_escalate", "bd_show", "bd_list", "bd_close", "bd_children", "check_git_state", "check_tmux_session", "bash", "none",
)

# Expected behaviours and what shows them
BEHAVIOURS = (
    ("runs gt hook", "gt hook"),
    ("runs gt mail inbox", "gt mail inbox"),
    ("runs gt mail read", "gt mail read"),
    ("runs gt prime", "gt prime"),
    ("runs bd create", "bd create"),
    ("runs bd close", "bd close"),
    ("runs git status", "git status"),
    ("runs git commit", "git commit"),
    ("runs git push", "git push"),
    ("checks hook", "gt hook"),
    ("checks mail", "gt mail"),
)

# Audits of workflow definitions
REQUIRED_FIELDS, FORMULA_TYPES = ("formula", "type", "version", "description"), ("workflow", "prompt", "data", "config")
SEVERITIES = ("critical", "high", "medium", "low", "info")
INSTRUCTION_WORDS = ("you must", "you should", "do not", "ensure", "verify", "check")
CONTEXT_WORDS = ("example", "context", "background", "given", "assume")
PROMPT_WORDS = ("prompt", "user", "assistant", "system")
FENCED_BLOCK = r"```(?:json)?\n([\s\S]*?)\n```"

# An adapter's training
TRAINING_CONFIG = {
    "model_type": "AutoModelForCausalLM", "tokenizer_type": "AutoTokenizer", "load_in_4bit": True, "adapter": "qlora", "lora_r": 64, "lora_alpha": 128, "lora_dropout": 0.05,
    "lora_target_linear": True, "val_set_size": 0.05, "sequence_len": 4096, "sample_packing": True, "pad_to_sequence_len": True, "gradient_accumulation_steps": 4, "micro_batch_size": 2,
    "num_epochs": 3, "learning_rate": 2e-4, "lr_scheduler": "cosine", "warmup_steps": 50, "optimizer": "adamw_torch", "weight_decay": 0.01, "max_grad_norm": 1.0, "bf16": "auto", "tf32": True,
    "flash_attention": True, "saves_per_epoch": 2, "eval_steps": 50, "logging_steps": 10,
}
SOFT_LABEL_WEIGHT = 0.5
