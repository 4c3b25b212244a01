"""Names, lists and limits that results depend on, stated in one place."""

# source_id, brand, channel, has a detail page, name of the key that grows with launch order
SOURCES = [
    ("cu", "CU", "convenience", True, "gd_idx"),
    ("orion", "오리온", "fmcg", True, None),
    ("starbucks", "스타벅스", "cafe", False, None),
    ("compose", "컴포즈커피", "cafe", False, None),
    ("baskinrobbins", "배스킨라빈스", "dessert", True, None),
    ("dunkin", "던킨", "dessert", True, None),
    ("kyochon", "교촌치킨", "restaurant", False, None),
    ("bbq", "BBQ", "restaurant", False, None),
    ("emart24", "이마트24", "convenience", False, None),
    ("mcdonalds", "맥도날드", "restaurant", False, None),
    ("momstouch", "맘스터치", "restaurant", False, None),
    ("bhc", "bhc치킨", "restaurant", False, None),
    ("dominos", "도미노피자", "restaurant", False, None),
    ("gs25", "GS25", "convenience", False, None),
    ("parisbaguette", "파리바게뜨", "dessert", True, None),
    ("burgerking", "버거킹", "restaurant", True, None),
    ("homeplus", "홈플러스", "mart", False, None),
    ("crown", "크라운제과", "fmcg", False, None),
    ("pizzahut", "피자헛", "restaurant", False, "rpst_seq"),
]

# channel code -> name shown on the page
CHANNEL_DISPLAY = [
    ("mart", "마트"),
    ("convenience", "편의점"),
    ("cafe", "카페"),
    ("dessert", "디저트"),
    ("restaurant", "음식점"),
    ("fmcg", "식품"),
]

# channel code -> name an editor is told
CHANNEL_EDITOR_LABEL = [
    ("convenience", "편의점"),
    ("mart", "대형마트"),
    ("cafe", "카페"),
    ("fmcg", "식품 브랜드"),
    ("dessert", "아이스크림·도넛 전문점"),
    ("restaurant", "프랜차이즈 음식점"),
]

OTHER_CATEGORY = "기타"

# channel code -> categories an edit may assign, in order
TAXONOMY = {
    "convenience": [
        "도시락", "김밥/주먹밥", "샌드위치/버거", "샐러드", "면류", "즉석조리",
        "디저트/베이커리", "과자", "아이스크림", "음료", "커피/차", "유제품",
        "주류", "안주", "가공식품/조미료", "기타",
    ],
    "mart": [
        "견과", "델리/즉석식품", "유제품", "냉장/냉동식품", "반찬/김치",
        "커피/차", "음료", "과자", "베이커리", "면류/통조림", "조미료/양념",
        "건강식품", "기타",
    ],
    "cafe": [
        "커피", "논커피 음료", "차", "주스/스무디", "블렌디드", "베이커리",
        "케이크/디저트", "샌드위치/샐러드", "기타",
    ],
    "fmcg": [
        "파이", "스낵", "비스킷/쿠키", "케이크", "초콜릿", "캔디/젤리", "껌",
        "시리얼/그래놀라", "바", "음료", "기타",
    ],
    "dessert": [
        "도넛", "빵", "케이크", "아이스크림", "아이스크림 케이크", "빙과/아이스바",
        "쿠키/구움과자", "초콜릿/캔디", "커피", "논커피 음료",
        "차/에이드", "블렌디드/빙수", "샌드위치/샐러드", "원두/캡슐",
        "간편식", "기타",
    ],
    "restaurant": [
        "치킨", "피자", "버거", "세트메뉴", "튀김/사이드", "떡볶이/분식",
        "밥/면", "탕/찌개", "샐러드", "디저트/스낵", "커피", "음료", "주류",
        "소스/부재료", "기타",
    ],
}

DROP_RATIO = 0.30
SPIKE_RATIO = 3.00
BOOTSTRAP_TOLERANCE = 0.10
MAX_LOOKBACK_WEEKS = 4
SIMILARITY_THRESHOLD = 0.85
PAIR_LIMIT = 2_000_000
TRACKED_FIELDS = ("name", "price", "image_url", "category_raw")
CROSS_SOURCE_KEYS = ("barcode",)
MAX_DETAIL_ROWS = 500
BATCH_SIZE = 20
MAX_BLURB_CHARS = 40
SAMPLE_PER_SOURCE = 10
MIN_PASS_RATE = 0.5
MIN_USER_TURNS = 3
TOOL_RESULT_CHARS = 600
TOOL_USE_CHARS = 400
THINKING_CHARS = 1500
RAW_RETENTION_DAYS = 90

REQUIRED_FIELDS = ("id", "week", "source_id", "brand", "channel", "name", "source_url",
                   "first_seen", "last_seen")

# role of a log record -> heading in a transcript
SPEAKERS = {"user": "나", "assistant": "Claude"}

# patterns
MARKUP_TAG = "<[^>]+>"
PRICE_RUN = "[0-9][0-9,]*"
BARCODE = "[0-9]{8,14}"
EPISODE_SUFFIX = "[12]편"
CSS_ADDRESS = r"""url\(\s*['"]?([^'")]+)"""
PAGE_DATA_ATTRIBUTE = r'(?s)<div id="app"[^>]*\sdata-page="(.*?)"'

# texts shown to readers
CLIP_NOTE = "\n… (총 %,d자, 이하 생략)"
TRANSCRIPT_TITLE = "# 세션 "
THINKING_TITLE = "> **생각**\n> \n> "
TOOL_CALL_MARK = "▶ "
WEEK_YEAR, WEEK_NUMBER, WON = "년 ", "주차", "원"
