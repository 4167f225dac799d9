"""Lookup tables, thresholds and labels that results must agree with.

Everything here is a plain constant in its natural order.  Larger tables (the full set of demand
scenarios, the category rules) are documents the caller passes in, see ``sources.rules``.
"""

# Membership grades, best first -> (name, minimum amount, minimum orders).
GRADES = [
    ("VIP", 5_000_000, 30),
    ("GOLD", 2_000_000, 15),
    ("SILVER", 500_000, 5),
    ("BRONZE", 0, 0),
]
GRADE_LOOKBACK_DAYS = 180
GRADE_RUN_INTERVAL_DAYS = 7

# Customer segments.
SEGMENT_VIP = "VIP"
SEGMENT_REGULAR = "일반"
SEGMENT_DORMANT = "휴면"
SEGMENT_VIP_AMOUNT = 5_000_000
SEGMENT_VIP_ORDERS = 30
SEGMENT_REGULAR_AMOUNT = 10_000

SUCCESS = "Success"
ABNORMAL_AMOUNT = 10_000_000
PAYMENT_METHODS = ["Card", "NaverPay", "KakaoPay", "Bank"]

# Weekday labels, Sunday first.
WEEKDAY_LABELS = ["일", "월", "화", "수", "목", "금", "토"]
HOUR_SUFFIX = "시"

# Districts with map coordinates (district, latitude, longitude).
DISTRICTS = [
    ("서울", 37.5665, 126.9780),
    ("경기", 37.4138, 127.5183),
    ("인천", 37.4563, 126.7052),
    ("부산", 35.1796, 129.0756),
    ("대구", 35.8714, 128.6014),
    ("대전", 36.3504, 127.3845),
    ("광주", 35.1595, 126.8526),
    ("울산", 35.5384, 129.3114),
    ("강원", 37.8228, 128.1555),
    ("충청", 36.6357, 127.4912),
    ("경상", 35.8000, 128.5000),
    ("전라", 35.4000, 127.0000),
    ("제주", 33.4996, 126.5312),
]

# Age bands (upper bound exclusive, label); the last band is open.
AGE_BANDS = [(20, "10대"), (30, "20대"), (40, "30대"), (50, "40대"), (None, "50대이상")]
AGE_BAND_DEFAULT = "30대"
UNKNOWN = "Unknown"

# Propensity points per attribute, with the points of an unlisted value.
AGE_POINTS = {"10대": 12, "20대": 20, "30대": 25, "40대": 22, "50대이상": 18}
GENDER_POINTS = {"F": 15, "M": 12}
STATUS_POINTS = {"ACTIVE": 20, "DORMANT": 5}
MARKETING_POINTS = {"true": 15, "false": 8}
GRADE_POINTS = {"VIP": 25, "GOLD": 20, "SILVER": 15, "BRONZE": 10}
POINTS_DEFAULT = {"age": 15, "gender": 12, "status": 10, "marketing": 8, "grade": 10}

# Activity multiplier per age band, hours 0 to 23.
HOUR_ACTIVITY = {
    "10대": [0.8, 0.5, 0.2, 0.1, 0.1, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7,
            0.9, 0.8, 0.7, 0.8, 0.9, 1.0, 1.2, 1.4, 1.6, 1.8, 1.5, 1.2],
    "20대": [0.7, 0.4, 0.2, 0.1, 0.1, 0.1, 0.2, 0.4, 0.6, 0.7, 0.8, 1.0,
            1.3, 1.1, 0.9, 0.8, 0.9, 1.0, 1.3, 1.5, 1.7, 1.8, 1.5, 1.0],
    "30대": [0.3, 0.1, 0.1, 0.1, 0.1, 0.1, 0.3, 0.5, 0.7, 0.9, 1.0, 1.2,
            1.4, 1.2, 1.0, 0.9, 0.8, 0.9, 1.1, 1.5, 1.8, 1.6, 1.0, 0.5],
    "40대": [0.2, 0.1, 0.1, 0.1, 0.1, 0.2, 0.4, 0.6, 0.8, 1.0, 1.2, 1.3,
            1.4, 1.2, 1.0, 0.9, 0.8, 0.9, 1.1, 1.4, 1.6, 1.3, 0.8, 0.4],
    "50대이상": [0.1, 0.1, 0.1, 0.1, 0.1, 0.3, 0.5, 0.8, 1.0, 1.3, 1.5, 1.6,
              1.4, 1.2, 1.0, 0.9, 0.8, 0.7, 0.8, 1.0, 1.1, 0.8, 0.5, 0.2],
}

# Promotion and life-event factors.
PROMO_PERCENT = 20
PROMO_FACTOR = 1.3
LIFE_EVENT_PERCENT = [85, 12, 3]
LIFE_EVENT_FACTOR = [1.0, 1.5, 3.0]

# Order volume multiplier, hours 0 to 23, and who takes the rounding remainder.
HOUR_VOLUME = [0.15, 0.05, 0.02, 0.01, 0.01, 0.03, 0.08, 0.20, 0.50, 0.80, 1.30, 1.60,
               1.40, 1.10, 1.00, 1.10, 1.20, 1.40, 1.80, 2.20, 3.00, 2.50, 1.50, 0.50]
REMAINDER_HOURS = [20, 19, 18, 21]

# Scenario that applies by hour; other hours use scenario 0, the baseline.
NIGHT_SCENARIO = 19
LATE_SCENARIO = 17
HOUR_SCENARIO = {**{h: NIGHT_SCENARIO for h in range(0, 6)}, **{h: LATE_SCENARIO for h in range(21, 24)}}

CATEGORIES = [
    "SS(봄여름)", "FW(가을겨울)", "스킨케어", "기능성(안티에이징)", "신선(과일/채소)", "육류/가공",
    "생활가전", "IT/게이밍", "세제/위생", "화지/제지", "건강식품", "영양제", "소파/침대", "사무/학생",
    "골프", "캠핑", "항공", "숙박", "티켓/패스",
]

# The scenarios that hours select (category weights list the overrides only).
HOUR_SCENARIO_DOCUMENT = {
    "0": {
        "gender_weights": {"M": 45, "F": 55},
        "age_group_weights": {"10대": 8, "20대": 28, "30대": 28, "40대": 22, "50대이상": 14},
        "category_weights": {
            "신선(과일/채소)": 12, "육류/가공": 10, "세제/위생": 8, "화지/제지": 6, "SS(봄여름)": 9,
            "FW(가을겨울)": 9, "스킨케어": 8, "영양제": 6, "생활가전": 5, "IT/게이밍": 5,
            "기능성(안티에이징)": 4, "건강식품": 4, "소파/침대": 2, "사무/학생": 2, "골프": 2, "캠핑": 2,
            "항공": 2, "숙박": 2, "티켓/패스": 2,
        },
        "quantity_weights": [75, 13, 7, 3, 2],
        "order_volume": {"min": 10, "max": 50},
    },
    "17": {
        "gender_weights": {"M": 35, "F": 65},
        "age_group_weights": {"10대": 5, "20대": 20, "30대": 35, "40대": 25, "50대이상": 15},
        "category_weights": {"신선(과일/채소)": 30, "육류/가공": 25, "세제/위생": 10, "화지/제지": 8},
        "quantity_weights": [40, 25, 20, 10, 5],
        "order_volume": {"min": 30, "max": 90},
    },
    "19": {
        "gender_weights": {"M": 55, "F": 45},
        "age_group_weights": {"10대": 10, "20대": 35, "30대": 30, "40대": 15, "50대이상": 10},
        "category_weights": {"신선(과일/채소)": 12, "세제/위생": 10, "스킨케어": 10, "IT/게이밍": 10},
        "quantity_weights": [90, 7, 2, 1, 0],
        "order_volume": {"min": 3, "max": 15},
    },
}

# Demand plan, month -> (orders of the month, [(scenario, weight) of weeks 1 to 4]).
MONTH_PLAN = {
    1: (3000, [(13, 0.8), (13, 0.7), (4, 1.2), (4, 1.3)]),
    2: (3200, [(4, 0.9), (0, 1.0), (11, 1.1), (11, 1.2)]),
    3: (3400, [(11, 1.3), (11, 1.1), (12, 1.0), (5, 1.0)]),
    4: (3600, [(10, 1.1), (15, 1.0), (12, 1.2), (10, 1.1)]),
    5: (3800, [(9, 1.3), (9, 1.4), (7, 1.1), (10, 1.0)]),
    6: (4000, [(5, 1.1), (5, 1.2), (16, 1.1), (16, 1.2)]),
    7: (4300, [(5, 1.2), (16, 1.4), (16, 1.5), (5, 1.1)]),
    8: (4600, [(16, 1.3), (5, 1.2), (18, 1.4), (11, 1.1)]),
    9: (4900, [(4, 1.3), (4, 1.5), (10, 1.1), (15, 1.0)]),
    10: (5200, [(10, 1.2), (15, 1.1), (6, 1.0), (6, 1.2)]),
    11: (5500, [(6, 1.1), (18, 1.3), (3, 2.0), (3, 1.8)]),
    12: (6000, [(6, 1.2), (16, 1.3), (20, 1.4), (8, 1.3)]),
}
WEEKEND_FACTOR = 1.3
FRIDAY_FACTOR = 1.15
WEEKDAY_FACTOR = 0.95

# Payment choice per age class, in percent.
PAYMENT_CHOICE = [
    ("1020", "Card", 45), ("1020", "NaverPay", 25), ("1020", "KakaoPay", 20), ("1020", "Bank", 10),
    ("30s", "Card", 50), ("30s", "NaverPay", 20), ("30s", "KakaoPay", 20), ("30s", "Bank", 10),
    ("40s", "Card", 65), ("40s", "NaverPay", 10), ("40s", "KakaoPay", 15), ("40s", "Bank", 10),
    ("50plus", "Card", 75), ("50plus", "Bank", 15), ("50plus", "NaverPay", 5), ("50plus", "KakaoPay", 5),
]
PAYMENT_CLASSES = [(30, "1020"), (40, "30s"), (50, "40s"), (None, "50plus")]
PAYMENT_CLASS_DEFAULT = "40s"

# Category rule defaults and basket sizes 1 to 10, in percent.
DEFAULT_FREQUENCY = 10
DEFAULT_QUANTITIES = [1, 2, 3, 4, 5]
DEFAULT_QUANTITY_WEIGHTS = [80, 10, 5, 3, 2]
BASKET_SIZE_WEIGHTS = [25, 20, 15, 12, 10, 7, 5, 3, 2, 1]

# Pool sizes.
POOL_SIZE = 1000
POOL_NEW_USERS = 400
POOL_NEW_PRODUCTS = 300
WARM_UP_DAYS = 7

# Alert steps (from this count on, this level).
STOCK_LEVELS = [(0, "green"), (1, "yellow"), (5, "red")]
INTEGRITY_LEVELS = [(0, "green"), (1, "red")]
ABNORMAL_LEVELS = [(0, "green"), (1, "yellow"), (5, "red")]

# Streams.
TOPICS = {"user": "users", "product": "products", "order": "orders"}
TOPIC_PARTITIONS = 3
LATE_AFTER = "10 minutes"
