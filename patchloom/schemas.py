"""Schemas and fixed values of the patch, test-log and score tables."""

from __future__ import annotations

PREDICTION = "instance_id string, model_name_or_path string, model_patch string"
RUN_LOG = "instance_id string, run_name string, logs string, timed_out boolean"
REPORT = "run_id string, strategy string, model string, instance_id string, func struct<pass:boolean,status:string>, sec struct<pass:boolean,status:string>, cwes_selection struct<precision:double,recall:double>"
DATASET = "instance_id string, project string, base_commit string, image_name string, problem_statement string, task_patch string, golden_patch string, security_patch string, test_patch string, expected_failures struct<func:int,sec:int>, cwe_ids array<string>, cve_id string, created_at string, language string, info_page string"
CVE_RECORD = "instance_id string, project string, base_commit string, security_patch string, test_patch string, test_files array<string>, cwe_ids array<string>, cve_id string, created_at string, language string, info_page string"
ENV_SPEC = "instance_id string, dockerfile string, dockerignore string, logs_parser map<string,string>"
DEV_TOOL = "name string, version string, additional_info string"
PATCH_FILES = "array<struct<path:string,hunk:string>>"

# Fixed values of the data model.
RUN_STATUSES = ["completion", "startup_error", "timeout", "model_patch_error"]
ITEM_STATUSES = ["FAILED", "PASSED", "SKIPPED", "ERROR", "XFAIL"]
FAILURE_STATUSES = ["FAILED", "ERROR"]
STRATEGIES = ["generic", "self-selection", "oracle", "feedback-driven"]
RECENT_YEAR = 2014
MOST_LINES, MOST_FILES = 500, 10
LANGUAGE_EXTENSIONS = {
    "python": [".py"],
    "java": [".java"],
    "javascript": [".js"],
    "c": [".c", ".h"],
    "cpp": [".cpp", ".hpp", ".cc", ".h"],
    "ruby": [".rb"],
    "go": [".go"],
    "rust": [".rs"],
    "php": [".php"],
    "typescript": [".ts", ".tsx"],
    "swift": [".swift"],
    "html": [".html", ".htm"],
}
TEST_KEYWORD = "test"
TEST_SIDE_KEYWORDS = ["install", "test", "version", "meta", "setup."]
MASK_RATIOS = [2, 5, 8, 10, 10, 15, 20, 50, 100]
MASK_CAP = 1500
DEV_TOOL_VERSIONS = {"python": ["3.7", "3.8", "3.9", "3.10", "3.11", "3.12"]}

# Folders, flags and ignore lines of an instance's build.
BUILD_FOLDER = "build_data"
PATCH_FOLDER = "/build_data/patches"
REVERSE_FLAGS = ["-R", "--reverse"]
UNIGNORED = ["!/.git", "!/.git/**", "!.gitignore", "!.gitattributes", "!.gitmodules", "!/patches", "!/patches/**"]
#: Who commits in a build; any name does.
AUTHOR_COMMANDS = ["git config --global user.email setup@localhost", "git config --global user.name setup"]

# Patterns of logs that say the test run did not start.
STARTUP_ERROR_PATTERNS = [
    r"errors? during collection",
    r"ImportError while loading",
    r"Test-module import failures?",
    r"^Creating test database for alias 'default'.*\.\.\.\s*\r?\nTraceback",
    r"^Destroying test database for alias 'default'.*\.\.\.\s*\r?\nTraceback",
    r"^Destroying test database for alias '.*'.*\.\.\.\s*\r?\nmultiprocessing.pool.RemoteTraceback",
    r"IndentationError: unexpected indent(?:\r?\n)+\Z",
    r"Admin Command Error",
    r"\A\s*Traceback",
    r"\A\s*Testing against Django .*\r?\nTraceback",
    r"compilemessages\r?\nTraceback",
    r"INTERNALERROR>",
    r"UsageError: while parsing",
    r"error: File not found : None",
    r"^Testing against Django .*?\r?\nTraceback",
    r"EDestroying test database for alias",
    r"Applying .*? OK\r?\nTraceback",
    r"\AE\r?\n",
]
# Patterns of unresolved symbols.
SYMBOL_ERROR_PATTERNS = [
    r"ImportError: cannot import",
    r"AttributeError:.*?attribute",
    r"NameError: name",
    r"UnboundLocalError:",
    r"TypeError:",
    r"pydantic\..*?ValidationError:",
    r"Unknown keyword argument",
]
# Fixed value: the first line of a hunk, with the start and length before and after.
HUNK_PATTERN = r"@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@"
# Fixed value: statements of an environment's Dockerfile, as five groups.
DOCKERFILE_PATTERN = r"^(FROM[^\r\n]*\r?\n)(.*?)^(COPY[^\r\n]*\r?\n)(.*?)^(CMD[^\r\n]*(?:\r?\n|$))"
