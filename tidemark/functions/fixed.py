"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the behaviour
being reproduced (word lists, templates, lookup tables, patterns,
defaults).  They are written plainly, in natural order, and used by the
expression builders in the sibling modules.
"""

# --- FIXED VALUES: address corpus ------------------------------------------

# Ten sample addresses with their known components
# (address, province, city, district, street).
ADDRESS_ROWS = [
    ("北京市海淀区中关村大街1号", "北京", "北京市", "海淀区", "中关村大街"),
    ("上海市浦东新区张江高科技园区", "上海", "上海市", "浦东新区", "张江高科技园区"),
    ("广东省深圳市南山区科技园南路100号", "广东", "深圳市", "南山区", "科技园南路"),
    ("浙江省杭州市西湖区文三路100号", "浙江", "杭州市", "西湖区", "文三路"),
    ("江苏省南京市鼓楼区中山路1号", "江苏", "南京市", "鼓楼区", "中山路"),
    ("四川省成都市武侯区天府软件园", "四川", "成都市", "武侯区", "天府软件园"),
    ("陕西省西安市雁塔区高新路", "陕西", "西安市", "雁塔区", "高新路"),
    ("湖北省武汉市武昌区东湖路", "湖北", "武汉市", "武昌区", "东湖路"),
    ("湖南省长沙市岳麓区橘子洲头", "湖南", "长沙市", "岳麓区", "橘子洲头"),
    ("山东省济南市历下区泉城广场", "山东", "济南市", "历下区", "泉城广场"),
]

# Built-in sample (on explicit request only): the first three addresses.
SAMPLE_ADDRESSES = 3

# Value meaning "component unknown" in the rule-based generator.
UNKNOWN = "未知"

# Keyword lists for the presence flags.
PROVINCE_KEYWORDS = ["省", "自治区"]
CITY_KEYWORDS = ["市", "州"]
DISTRICT_KEYWORDS = ["区", "县", "旗"]
STREET_KEYWORDS = ["街", "路", "道", "巷", "胡同"]

# Component patterns of the regex-based generator (group 1 is the value).
PROVINCE_PATTERN = "([^省]+省)"
CITY_PATTERN = "([^市]+市)"
DISTRICT_PATTERN = "([^区]+区|[^县]+县)"
STREET_PATTERN = "([^街]+街|[^路]+路|[^道]+道)"

# Question / answer templates, rule-based generator.
Q_PROVINCE = "这个地址在哪个省？"
Q_CITY = "这个地址在哪个市？"
Q_DISTRICT = "这个地址在哪个区/县？"
Q_STANDARD = "请标准化这个地址："
A_PREFIX = "这个地址在"
A_PROVINCE_SUFFIX = "省"
A_STANDARD = "标准化地址："
# Answers of the regex-based generator when a component is missing; such
# pairs are dropped because their output contains NOT_SURE.
A_NO_PROVINCE = "无法确定省份"
A_NO_CITY = "无法确定城市"
NOT_SURE = "无法确定"

# Minimum cleaned-address length kept.
MIN_ADDRESS_LEN = 3

# --- FIXED VALUES: chat text ------------------------------------------------

IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
# Training text, plain dialogue and generation prompt.
CHAT_TRAIN = "<|im_start|>user {instruction} <|im_end|> <|im_start|>assistant {output} <|im_end|>"
CHAT_PLAIN = "用户: {instruction}\n助手: {output}"
CHAT_PROMPT = "<|im_start|>user\n{instruction}<|im_end|>\n<|im_start|>assistant\n"
ASSISTANT_MARKER = "<|im_start|>assistant\n"

# --- FIXED VALUES: vocabulary (58 entries, ids 0-57) --------------------------

VOCAB = {
    '[PAD]': 0, '[UNK]': 1, '[CLS]': 2, '[SEP]': 3, '[MASK]': 4,
    '<|im_start|>': 5, '<|im_end|>': 6, 'user': 7, 'assistant': 8,
    '这个': 9, '地址': 10, '在': 11, '哪个': 12, '省': 13, '市': 14,
    '区': 15, '县': 16, '请': 17, '标准化': 18, '北京': 19, '上海': 20,
    '广东': 21, '深圳': 22, '浙江': 23, '杭州': 24, '江苏': 25, '南京': 26,
    '四川': 27, '成都': 28, '陕西': 29, '西安': 30, '湖北': 31, '武汉': 32,
    '湖南': 33, '长沙': 34, '山东': 35, '济南': 36, '海淀': 37, '浦东': 38,
    '南山': 39, '西湖': 40, '鼓楼': 41, '武侯': 42, '雁塔': 43, '武昌': 44,
    '岳麓': 45, '历下': 46, '中关村': 47, '张江': 48, '科技园': 49, '大街': 50,
    '路': 51, '号': 52, '无法': 53, '确定': 54, '。': 55, '，': 56, '：': 57,
}
PAD_ID = 0
UNK_ID = 1
UNK_TOKEN = "[UNK]"
MAX_LENGTH = 128

# Train / eval split: 20 % eval, seed 42.
EVAL_PERCENT = 20
SPLIT_SEED = 42

# --- FIXED VALUES: exchange-rate refresh ------------------------------------

# base currency -> targets (18 pairs)
CURRENCY_PAIRS = {
    'USD': ['EUR', 'GBP', 'JPY', 'CAD', 'AUD', 'CHF', 'CNY', 'HKD'],
    'EUR': ['USD', 'GBP', 'JPY', 'CHF'],
    'GBP': ['USD', 'EUR', 'JPY'],
    'JPY': ['USD', 'EUR', 'GBP'],
}

# Reference rates used when the fetched rate is missing or zero.
FALLBACK_RATES = {
    'USD': {'EUR': 0.85, 'GBP': 0.73, 'JPY': 110.5, 'CAD': 1.25},
    'EUR': {'USD': 1.18, 'GBP': 0.86, 'JPY': 130.0},
    'GBP': {'USD': 1.37, 'EUR': 1.16, 'JPY': 151.0},
    'JPY': {'USD': 0.0091, 'EUR': 0.0077, 'GBP': 0.0066},
}
# Range of the substitute value when no reference rate exists.
RANDOM_RATE_LOW = 0.5
RANDOM_RATE_HIGH = 150.0
RANDOM_RATE_DECIMALS = 4

FALLBACK_SOURCE = "fallback"
TIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_TEXT_FORMAT = "yyyy-MM-dd"

# --- FIXED VALUES: weather regions --------------------------------------------

# province -> region; anything not listed is DEFAULT_REGION.
REGION_PROVINCES = {
    '东北': ['黑龙江', '吉林', '辽宁'],
    '华南': ['广东', '广西', '海南', '福建'],
    '华东': ['江苏', '浙江', '上海', '安徽'],
    '西南': ['四川', '云南', '贵州', '重庆'],
    '西北': ['陕西', '甘肃', '宁夏', '青海', '新疆'],
}
DEFAULT_REGION = '华北'
# Province dimension of the weather refresh (34 entries, in the original
# order); its size is the denominator of the coverage ratio.
PROVINCES = [
    '北京', '天津', '上海', '重庆', '河北', '山西', '辽宁', '吉林', '黑龙江',
    '江苏', '浙江', '安徽', '福建', '江西', '山东', '河南', '湖北', '湖南',
    '广东', '海南', '四川', '贵州', '云南', '陕西', '甘肃', '青海', '台湾',
    '内蒙古', '广西', '宁夏', '新疆', '西藏', '香港', '澳门',
]
# Whole-record default when a weather fetch fails.
WEATHER_FALLBACK = {"weather": "多云", "temperature": "10°C-20°C", "wind": "微风"}
# region -> (low, high)
TEMP_RANGES = {
    '东北': ('5℃', '15℃'), '华北': ('8℃', '20℃'), '华东': ('10℃', '22℃'),
    '华南': ('15℃', '28℃'), '西南': ('12℃', '24℃'), '西北': ('3℃', '18℃'),
}
DEFAULT_TEMP_RANGE = ('10℃', '22℃')

# --- FIXED VALUES: change stream ----------------------------------------------

SOURCE_DB = "postgresql"
PASS_THROUGH_FORMAT = "original"
# Metadata attached to a flattened change; these names win over payload
# fields of the same name.
CHANGE_META_FIELDS = ["source_db", "cdc_time", "original_change_id",
                      "original_operation", "original_table_name"]
OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"
POLL_INTERVAL = "3 seconds"
# Topic load: a batch closes after 20 s; its size is the caller's choice.
LOAD_TRIGGER = "20 seconds"
# Day partitions kept around today, and hash buckets on the id.
RETENTION_DAYS_BEFORE = 7
RETENTION_DAYS_AFTER = 3
TABLE_BUCKETS = 8

# Versions kept per key/column in the wide-column store.
KV_MAX_VERSIONS = 3
