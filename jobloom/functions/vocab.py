"""Rule vocabulary for job-title scoring and classification.

Everything between the two FIXED VALUES markers below must stay equal to the
behaviour this engine reproduces: the terms, their order inside a tier, the tier
order and the numeric tier values decide scores and labels. Entries are regex
fragments (``.`` = any character except LF, ``?`` = optional), written lower
case. How they are combined into patterns lives in ``scoring.py``.
"""

from __future__ import annotations

# ----------------------------------------------------------------- FIXED VALUES
# Leadership tiers (first tier that matches wins; every term is a whole word;
# a term ending in "." still needs a word character right after the dot).
LEADERSHIP_TIERS: list[tuple[int, list[str]]] = [
    (40, ["chief", "vice president", "vp", "director of", "c-level", "cxo",
          "head of engineering", "head of product"]),
    (36, ["principal", "distinguished", "fellow", "engineering manager", "tech lead",
          "technical lead", "team lead", "lead", "staff engineer"]),
    (28, ["architect", "senior", r"sr\.", "sr", "staff"]),
    (8, ["junior", r"jr\.", "intern", "graduate", "entry.level", "entry level"]),
    (16, ["mid", "intermediate", "ii", "2"]),
]
LEADERSHIP_DEFAULT = 14
LEADERSHIP_EMPTY_TEXT = 10

# Inferred years of experience when the text states none (same word rules).
INFERRED_YEARS_TIERS: list[tuple[int, list[str]]] = [
    (10, ["chief", "vice president", "vp", "director of", "c-level", "cxo", "head of",
          "distinguished", "fellow"]),
    (8, ["principal", "engineering manager", "tech lead", "technical lead", "team lead",
         "staff engineer", "architect"]),
    (7, ["lead"]),
    (5, ["senior", r"sr\.", "sr", "staff"]),
    (3, ["mid", "intermediate", "ii"]),
    (1, ["junior", r"jr\.", "intern", "graduate", "entry.level", "entry level"]),
]
INFERRED_YEARS_DEFAULT = 2

# Explicit years phrases, case-insensitive; every capture group is a number.
YEARS_PATTERNS: list[str] = [
    r"(?:minimum|min\.?|at least|\+)\s*(\d{1,2})\s*\+?\s*(?:years?|yrs?)",
    r"(\d{1,2})\s*\+\s*years?",
    r"(\d{1,2})\s*-\s*(\d{1,2})\s*years?",
    r"(\d{1,2})\s+years?\s+(?:of|experience|in)\b",
    r"(\d{1,2})\s+years?\b",
]
YEARS_CAP = 25

# Skill tokens, case-insensitive, whole word, tried left to right at each position.
SKILLS: list[str] = [
    "python", "java", "javascript", "typescript", r"c\+\+", "c#", r"\.net", "golang", "go",
    "rust", "kotlin", "swift", "ruby", "php", "scala",
    "react", "angular", r"vue\.?js", r"node\.?js", "django", "flask", "fastapi", "spring",
    "kafka", "spark", "hadoop", "airflow", "dbt",
    "tensorflow", "pytorch", "keras", "scikit", "nlp", "machine learning", "deep learning",
    "computer vision", "genai", "llm",
    "aws", "azure", "gcp", "ml", "ai", "google cloud", "cloud", "kubernetes", "k8s", "docker",
    "terraform", "ansible", "jenkins",
    "ci/cd", "git", "github",
    "sql", "nosql", "mongodb", "postgres", "postgresql", "mysql", "redis", "elasticsearch",
    "snowflake", "bigquery", "databricks",
    "linux", "unix", "bash", "powershell", "agile", "scrum", "jira", "graphql", "rest api",
    "microservices", "devops", "sre", "finops",
    "backend", "frontend", "full[- ]?stack", "mobile", "ios", "android", "data engineer",
    "analytics", "algorithms?",
    "graphics", "multimodal", "blockchain", "saas", "tableau", "opencv", "cuda", "ffmpeg",
    "html", "css", "webpack", r"next\.?js", "express",
    "nginx", "oauth", "ssl", "tls", "ui", "ux", "qa", "quality assurance",
]

# Category rules on lower-cased text, first label that matches wins.
# Plain terms match anywhere; \b marks an ASCII word boundary.
CATEGORY_RULES: list[tuple[str, list[str]]] = [
    ("Engineering", ["engineer", "developer", "software", "devops", r"\bsre\b", "algorithm",
                     "backend", "frontend", "full.?stack", "data engineer", r"\bml\b",
                     "machine learning", "graphics", r"\bc\+\+", "programming", "cloud finops",
                     "finops", "infrastructure", "platform", "qa ", "quality assurance",
                     "security engineer", "nlp", "algorithm developer", "genai"]),
    ("Product", ["product manager", "product owner", r"\bpm\b", "director of product",
                 "product lead"]),
    ("Design", ["designer", r"ux\b", r"ui\b", "motion", "after effects", "creative", "figma",
                "visual design"]),
    ("Operations", ["accountant", "controller", "finance", r"\bfp&a\b", "financial",
                    "marketing", "sales", "legal counsel", r"\bhr\b", "human resources",
                    "people&culture", "people and culture", "office manager", "partnership",
                    "revenue", "recruit", "talent", "operations manager", "bizdev",
                    "business development", "client solutions", "delivery"]),
]
CATEGORY_DEFAULT = "Other"

# Seniority rules on lower-cased text, first rule that matches wins.
SENIORITY_RULES: list[tuple[str, list[str]]] = [
    ("Lead", [r"\bchief\b", "vice president", r"\bvp\b", r"\bcdo\b", r"\bcto\b", r"\bcfo\b",
              "director of", "head of", "distinguished", "fellow"]),
    ("Lead", [r"\blead\b", "principal", "staff engineer", "engineering lead", "tech lead",
              "technical lead", "architect"]),
    ("Senior", ["senior", r"\bsr\.?\b", r"staff\b"]),
    ("Junior", ["junior", r"\bjr\.?\b", "intern", "graduate", "entry.level", "entry level"]),
]
SENIORITY_DEFAULT = "Mid"

ALLOWED_CATEGORIES = ("Design", "Engineering", "Operations", "Other", "Product")
ALLOWED_SENIORITY = ("Junior", "Lead", "Mid", "Senior")

# Score arithmetic: years weigh 3 per year up to 30, skills 2 each up to 30, total <= 100.
YEARS_WEIGHT, YEARS_POINTS_CAP = 3, 30
SKILL_WEIGHT, SKILL_POINTS_CAP = 2, 30
SCORE_CAP = 100

# URL cleaning: query keys dropped for dedupe (compared lower-case).
TRACKING_QUERY_PREFIXES = ("utm_",)
TRACKING_QUERY_KEYS = ("fbclid", "gclid", "_ga", "mc_eid")
NON_HTTP_PREFIXES = ("javascript:", "mailto:", "tel:", "data:")
JOB_PATH_MARKER = "career"
NOT_A_SLUG = ("career", "careers")
TITLE_SUFFIX = r"\s*View\s+Position\s*$"

# Limits and defaults of the producer / consumer.
MAX_RESPONSE_BYTES = 15 * 1024 * 1024
MAX_RESPONSE_BYTES_FLOOR = 1024
TITLE_MAX_CHARS = 2000
MAX_MESSAGE_BYTES = 1024 * 1024
MAX_MESSAGE_BYTES_FLOOR = 1024
ROWS_PER_PAYLOAD = 2000
SHORT_PAGE_CHARS = 50000
SHORT_PAGE_ROWS = 12
KEY_NAME_MAX, TOPIC_NAME_MAX, LABEL_NAME_MAX = 100, 80, 80
DEFAULT_BLOB_PREFIX = "careers-parquet/"
TITLE_ONLY_KEY = "open_positions"
BATCH_KEY_FORMAT = "parquet-batch-{}"
PAYLOAD_CONTENT_TYPE = "application/vnd.apache.parquet"
# ----------------------------------------------------------------- FIXED VALUES
