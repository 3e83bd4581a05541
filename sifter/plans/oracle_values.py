"""Values that the DuckDB statements use, written out here once more.

The statements must not read them from the code under test: a marker, template
or range that is missing there has to show as a difference.
"""
from __future__ import annotations

# The error texts of the request-log view, by event_id % 12.
ERROR_TEXTS = (
    None,
    None,
    'HTTP 429: {"error": {"status": "RESOURCE_EXHAUSTED", "details": [{"retryDelay": "1.5s"}]}}',
    'HTTP 503: {"error": "model_cooldown", "quotaResetDelay": "1h2m3s"}',
    "JSON 解析失败: Expecting value: line 1 column 1 (char 0); 片段: abc",
    "Network error: <urlopen error timed out>",
    'HTTP 404: {"error": "The model is no longer available, please switch to another"}',
    'HTTP 500: internal error "reset_seconds": 7',
    "HTTP 400: bad request",
    'HTTP 502: upstream "retryDelay": "x", "resetTime": "2s"',
    "Read timed out. (read timeout=300)",
    'Rate limit reached: "reset_time": "0s"',
)

# Lower-case markers searched in error texts, per error class.
RETRIABLE = (
    "http 408", "http 429", "http 500", "http 502", "http 503", "http 504",
    "rate limit", "resource_exhausted", "quota", "model_capacity_exhausted",
    "unavailable", "auth_unavailable", "timeout", "timed out", "read timed out",
    "connection timed out", "timeouterror", "temporarily",
)
QUOTA = (
    "http 429", "rate limit", "quota", "resource_exhausted", "quota_exhausted",
    "model_cooldown", "cooling down", "model_capacity_exhausted",
)
JSON_PARSE = (
    "expecting value", "jsondecodeerror", "invalid json", "not json",
    "json 解析失败", "解析失败", "不是 json", "不是json",
)
TIMEOUT = ("timed out", "timeout", "timeouterror", "read timed out", "connection timed out")
MODEL_UNAVAILABLE = (
    "no longer available", "model is no longer available", "please switch to", "switch to",
)

# Keys of a retry delay, duration forms.
DELAY_KEYS = ("retryDelay", "quotaResetDelay", "reset_time", "resetTime")
SECONDS_KEY = "reset_seconds"
SECONDS_ONLY = "^(\\d+(?:\\.\\d+)?)s$"
HMS = "^(?:(\\d+(?:\\.\\d+)?)h)?(?:(\\d+(?:\\.\\d+)?)m)?(?:(\\d+(?:\\.\\d+)?)s)?$"

# The few-shot prompt text, as format strings.
PROMPT_TEMPLATE = {
    "header": (
        "你是一个强化学习与具身智能领域的数据生成专家。"
        "请模仿下面示例的格式，生成 {n} 条全新的无人机集群调度任务数据。\n\n"
        "要求：\n"
        "1. input 必须是自然语言战术意图。\n"
        "2. output 必须是严格 JSON 字符串，且与 input 对应。\n"
        "3. 不要与示例重复，场景可创新（如反潜、电磁静默、诱捕、搜救、星际探索等）。\n"
        "4. 输出必须是严格 JSON 数组，每个元素是 JSON 对象。\n\n"
        "### 示例开始 ###\n"
    ),
    "example": "【例子 {idx}】\nInput: {input}\nOutput: {output}\n\n",
    "footer": (
        "### 示例结束 ###\n\n"
        "请只输出 JSON 数组，数组元素仅包含 instruction、input、output 三个字段。"
        "不要输出任何额外解释。"
    ),
}

# The procedural generator's instruction, task types, input
# texts, output documents and parameter ranges or choices.
PROC_INSTRUCTION = (
    "你是一个具身智能无人机集群的战术指挥中枢，请将用户的自然语言战术意图"
    "转换为结构化 JSON 调度指令。只输出 JSON，不要额外解释。"
)
TASKS = [
    {
        "task_type": "simple_tag",
        "input": "演练开始，敌方释放{prey}架诱饵机，我方出动{predators}架拦截机进行追击。要求左右包抄，先压缩逃逸空间再捕获；尽量避免友机碰撞。",
        "output": '{{"task_type": "simple_tag", "agents_config": [{{"role": "predator", "count": {predators}, "strategy": "pincer_and_compress"}}, {{"role": "prey", "count": {prey}, "strategy": "evasion"}}], "rl_parameters": {{"capture_reward": {capture_reward}, "collision_penalty": {collision_penalty}}}}}',
        "params": [
            ("predators", "int", (2, 6)),
            ("prey", "int", (1, 3)),
            ("capture_reward", "choice", ("40.0", "60.0", "80.0", "100.0")),
            ("collision_penalty", "choice", ("-10.0", "-20.0", "-50.0", "-100.0")),
        ],
    },
    {
        "task_type": "regional_capture",
        "input": "启动区域控制任务，派遣无人机在 Alpha 区进行网格化巡逻搜索；任意一架发现目标后其余立刻收缩合围。",
        "output": '{{"task_type": "regional_capture", "agents_config": [{{"role": "patrol", "count": {n}, "strategy": "grid_search_and_surround"}}], "rl_parameters": {{"coverage_reward": 20.0, "cooperative_capture_reward": 80.0, "collision_penalty": -10.0}}}}',
        "params": [("n", "int", (3, 8))],
    },
    {
        "task_type": "escort_and_navigate",
        "input": "我方运输机穿越峡谷，派护航无人机组成三角队形伴飞。途中允许开启强化避障算法，优先保证安全，其次保持队形。",
        "output": '{{"task_type": "escort_and_navigate", "agents_config": [{{"role": "vip", "count": 1, "strategy": "follow_waypoints"}}, {{"role": "escort", "count": {escorts}, "strategy": "triangle_formation"}}], "rl_parameters": {{"formation_keeping_reward": 15.0, "obstacle_avoidance_penalty": -30.0}}}}',
        "params": [("escorts", "int", (2, 5))],
    },
    {
        "task_type": "urban_search",
        "input": "目标进入城市密集建筑区，所有无人机切换低空静默模式，单机独立搜索。发现目标后上报并保持跟踪，不要依赖队友通信。",
        "output": '{{"task_type": "urban_search", "agents_config": [{{"role": "searcher", "count": {n}, "strategy": "independent_stealth"}}], "rl_parameters": {{"discovery_reward": 50.0, "comm_dependency_penalty": -5.0, "altitude_limit": "low"}}}}',
        "params": [("n", "int", (3, 10))],
    },
    {
        "task_type": "survival_evasion",
        "input": "集群遭遇强电磁干扰，立刻解散当前队形，所有无人机执行随机规避动作。优先保证生存，碰撞惩罚设为最高。",
        "output": '{{"task_type": "survival_evasion", "agents_config": [{{"role": "all", "count": "all", "strategy": "random_evasion_no_comm"}}], "rl_parameters": {{"survival_reward_per_step": 1.0, "collision_penalty": -100.0}}}}',
        "params": [],
    },
    {
        "task_type": "tactical_breach",
        "input": "对敌方基地进行模拟突防：多架无人机作为诱饵吸引火力，主攻机趁机隐蔽渗透突防。成功突防奖励最高，诱饵损失惩罚较低。",
        "output": '{{"task_type": "tactical_breach", "agents_config": [{{"role": "decoy", "count": {decoys}, "strategy": "draw_fire"}}, {{"role": "attacker", "count": 1, "strategy": "stealth_penetration"}}], "rl_parameters": {{"breach_success_reward": 200.0, "decoy_sacrifice_penalty": -10.0}}}}',
        "params": [("decoys", "int", (2, 4))],
    },
]
