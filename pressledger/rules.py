"""Fixed values of the publication contract. Results depend on them, so they are stated as they are."""

# --- fixed values: categories, quotas, cutoffs -------------------------------------------------
CATEGORIES = ("Paper", "News", "Policy")
ELIGIBLE_PHASES = ("Migrated", "Released")
SELECTION_LIMIT = 20
PAPER_CAPACITY = 10
POLICY_CAPACITY = 3
NEWS_POLICY_CAPACITY = 10
NEWS_TARGET = 5
CUTOFF = 60
POLICY_CUTOFF = 55
PAPER_MIN_RELEVANCE = 15
EMPHASIS_RANK = 3
UNREVISED_POLICY_CAPACITY = 5
LEGACY_COUNTS = {"Paper": 10, "News": 6, "Policy": 5}
LEGACY_REVISION = r"^[A-Za-z0-9][A-Za-z0-9._-]{0,79}$"

# --- fixed values: score caps per track, in rubric order ---------------------------------------
SCORE_CAPS = {
    "Paper": {"relevance": 30, "novelty": 20, "credibility": 20, "impact": 15, "team": 10, "timeliness": 5},
    "News": {"materiality": 30, "evidence": 25, "impact": 20, "novelty": 15, "timeliness": 10},
    "Policy": {"materiality": 30, "authority": 25, "scope": 20, "implementation": 15, "timeliness": 10},
}
NEWS_BONUS = 5

# --- fixed values: sections and stage sequences ------------------------------------------------
SECTIONS = {
    "Paper": ["研究问题与贡献", "方法与系统", "实验设置与数据", "结果、限制与结论", "来源链接"],
    "News": ["事件概述", "已确认事实与证据", "影响与后续观察", "来源链接"],
    "Policy": ["政策行动", "适用范围与约束力", "关键条款", "时间线", "影响与待观察事项", "来源链接"],
}
IMAGE_STAGES = {
    "Paper": ["figure1", "tex", "pdf", "html", "project", "repository"],
    "News": ["official", "attachments"],
    "Policy": ["official", "attachments"],
}
STAGE_STATUSES = ("found", "unavailable", "unsuitable")
EVIDENCE_KINDS = ("full_text", "official", "supplement", "attempt")
EVIDENCE_LIMIT = 24
VALIDATION_CHECKS = ("grouped_selection", "refine", "schema", "taxonomy", "images", "ownership", "quotas", "evidence")

# --- fixed values: recall ----------------------------------------------------------------------
SUBJECTS = ("cs.RO", "cs.AI", "cs.CV", "cs.LG", "cs.CL", "cs.MA", "eess.SY")
TOPIC_TERMS = {
    "embodied_robotics": [
        "embodied intelligence", "embodied AI", "robot learning", "robot foundation model", "robot manipulation",
        "robot control", "robot policy",
        "具身智能", "机器人学习", "机器人基础模型", "机器人操作", "机器人控制", "机器人策略"],
    "arm_vla": [
        "vision-language-action", "VLA", "language-conditioned manipulation", "vision-language policy",
        "robot manipulation", "manipulation foundation model",
        "视觉-语言-动作", "视觉语言动作", "语言条件操作", "视觉语言策略", "机械臂", "机器人操作"],
    "drone_vla_vln": [
        "drone", "UAV", "aerial robot", "unmanned aerial vehicle", "vision-language navigation", "VLN",
        "aerial navigation", "autonomous flight", "space robotics", "orbital robotics", "on-orbit", "in-orbit",
        "on-orbit servicing", "space manipulation", "satellite servicing", "lunar robot", "Mars robot",
        "aerospace embodied AI",
        "无人机", "空中机器人", "视觉语言导航", "空中导航", "自主飞行", "空天具身智能", "航天具身智能", "航空具身智能",
        "太空机器人", "空间机器人", "在轨机器人", "在轨操作", "在轨抓取", "在轨服务", "卫星服务", "太空抓取", "月球机器人",
        "火星机器人", "低空经济", "低空飞行器"],
    "embodied_infra": [
        "robot data", "robot dataset", "robot simulator", "robot simulation", "teleoperation", "robot deployment",
        "robot benchmark", "embodied infrastructure",
        "机器人数据", "机器人数据集", "机器人仿真器", "机器人仿真", "遥操作", "机器人部署", "机器人评测", "具身基础设施"],
    "world_model": [
        "world model", "world models", "video world model", "world model for robotics", "predictive model",
        "environment model", "interactive simulation",
        "世界模型", "视频世界模型", "预测模型", "环境模型", "交互式仿真"],
    "llm_vlm_methods": [
        "large language model", "LLM", "vision-language model", "VLM", "multimodal", "agent",
        "reinforcement learning", "imitation learning", "offline reinforcement learning", "reward model",
        "大语言模型", "视觉语言模型", "多模态", "智能体", "强化学习", "模仿学习", "离线强化学习", "奖励模型"],
}
ACRONYMS = ("VLA", "VLN", "LLM", "VLM")

# --- fixed values: metadata bounds -------------------------------------------------------------
CONTROL_KEYS = ("identity", "paths", "counts", "checksums", "status", "reason", "context_id", "session_id")
CONTROL_BYTES = 16384
EVENT_FIELDS = ("key", "source_id", "version", "announce_type", "announce_types", "announcement_at",
                "first_seen_at", "last_seen_at", "source_categories", "status", "cycle_id", "canonical_url")
EVENT_LISTS = ("announce_types", "source_categories")
EVENT_BYTES = 4096
CURSOR_FORBIDDEN = ("body", "content", "summary", "files", "base64", "events")
CURSOR_BYTES = 16384
EVENT_STATUSES = ("seen", "pending", "emitted")

# --- fixed values: identity patterns -----------------------------------------------------------
PREPRINT = r"(?:arxiv:|arxiv\.org/(?:abs|pdf)/)(\d{4}\.\d{4,5})(?:v\d+)?"
TEXT_URL = r"""(?U)https?://[^\s<>"\)\]\}]+"""
CANDIDATE_ID = r"\A[A-Za-z0-9](?:[A-Za-z0-9._~\-]|%[0-9A-Fa-f]{2})*\z"
CANDIDATE_ID_CHARS = 240

# --- fixed values: URL, text and tree rules ----------------------------------------------------
RESERVED_SUFFIXES = (".localhost", ".local", ".internal", ".test", ".invalid", ".example", ".home.arpa")
AUTH_PARAMETER = r"(?i)token|secret|password|api.?key|signature|credential"
# case and white space are those of Unicode, as (?iU) says
PRIVATE_MARKERS = r"(?iU)working_tmp|crawl_tmp|file://|/home/|/Users/|Bearer\s|Authorization:|GRIST_API_KEY|javascript:|data:text/html|<script|\{\{"
HOME_PATH = r"/(?:home|Users)/[A-Za-z0-9._-]+/"
AUTHORIZATION = r"(?iU)authorization\s*:\s*(?:bearer\s+)?[A-Za-z0-9._~+/-]{16,}"
PRIVATE_KEY = r"-----BEGIN (?:OPENSSH |RSA |EC )?PRIVATE KEY-----"
EXCLUDED_FOLDERS = (".local", ".git", ".venv", "state", "working_tmp", "crawl_tmp", "node_modules", "dist",
                    "__pycache__")
EXCLUDED_FILES = (".env", ".repo_private_key", ".repo_private_key.pub", "refact.jsonl")
TEXT_SUFFIXES = (".py", ".md", ".json", ".toml", ".yml", ".yaml", ".sh", ".mjs", ".mts", ".ts", ".vue", ".css",
                 ".html", ".txt", ".example", ".prompt")
ALWAYS_TEXT_FILES = ("AGENTS.md", ".env.example")
ARTIFACT_FILES = 20_000
ARTIFACT_BYTES = 2_000_000_000
SAMPLED_ARTIFACTS = 16
MESSAGE_CHARS = 4000
SECTION_CHARS = 150_000
IMAGE_EXTENSIONS = {"PNG": ["png"], "JPEG": ["jpg", "jpeg"], "WEBP": ["webp"], "GIF": ["gif"], "AVIF": ["avif"]}
IMAGE_BYTES = 20 * 1024 * 1024
ZONE = "Asia/Shanghai"
