"""Code lists and display names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.functions.sql import literal, name

UNKNOWN = "###"

# Payment method codes, engine column and display label.
PAY_METHOD_COLUMNS = {
    1: "cash",
    2: "alipay",
    3: "wechat",
    4: "bank_card",
    5: "member_account",
    6: "other_method",
    7: "leshua",
    8: "commercial_insurance",
    9: "on_account",
    10: "citizen_card",
}
PAY_METHOD_LABELS = {
    1: "现金",
    2: "支付宝",
    3: "微信",
    4: "银行卡",
    5: "会员账号",
    6: "其它",
    7: "乐刷支付",
    8: "商保",
    9: "挂账",
    10: "市民卡",
}

# Inquiry order states.
INQUIRY_STATES = {
    10: "待填写患者详情",
    11: "待回复",
    12: "待通话",
    13: "问诊中",
    14: "已完成",
}

# Online order states.
ONLINE_STATES = {
    0: "待付款",
    1: "待发货",
    2: "部分发货（中药已发货）",
    3: "部分发货（西药/成药已发货）",
    4: "已发货（全部药品已发货）",
    5: "已取消",
    6: "已关闭",
}

# Payment states.
PAY_STATES = {
    0: "待支付",
    9: "预支付",
    1: "支付完成",
    5: "已退款",
}

# Two-way labels (code that gets the first label, first label, second label).
INQUIRY_TYPE = (10, "图文问诊", "电话问诊")
ABNORMAL = (0, "正常", "异常")
SEX = (1, "男", "女")

# Display names of the payment-method and fee-category reports.
PAYMENT_NAMES = {
    "hospital_name": "诊所名称",
    "depart_name": "科室",
    "doctor_name": "医生",
    "pay_day": "付款日期",
    "original_amount": "原价",
    "receivable_amount": "应收",
    "pay_amount": "实收",
    "deposit_amount": "折扣优惠",
    "medical_fund_payment": "医保",
    "period_start": "开始时间",
    "period_end": "结束时间",
} | {PAY_METHOD_COLUMNS[code]: label for code, label in PAY_METHOD_LABELS.items()}

CHARGE_NAMES = {
    "hospital_name": "诊所名称",
    "depart_name": "科室",
    "doctor_name": "医生",
    "pay_day": "付款日期",
    "registered_fee": "挂号费",
    "medical_fee": "治疗",
    "material_fee": "耗材",
    "instrument_fee": "器械",
    "trad_medicine_fee": "中药处方",
    "decoction_fee": "代煎费",
    "west_medicine_fee": "西药处方",
    "cp_medicine_fee": "中成药处方",
    "check_fee": "门诊检验费",
    "inspect_advice_fee": "门诊检查费",
    "other1_fee": "生长激素",
    "other2_fee": "器械1",
    "other3_fee": "自定义分类3",
    "other4_fee": "自定义分类4",
    "exam_in_room": "科室体检费",
    "exam_check": "体检检验费",
    "exam_inspect": "体检检查费",
    "other_fee": "其他收费",
    "diagnosis_fee": "诊疗费",
    "receivable_amount": "折后总额",
    "period_start": "开始时间",
    "period_end": "结束时间",
}

# Display names of the visit, income-cost and merged reports.
INDICATOR_NAMES = {
    "hospital_name": "诊所名称",
    "doctor_name": "医生姓名",
    "consultants_name": "标记医生姓名",
    "month": "日期",
    "visits": "接诊人次",
    "return_visits": "复诊人次",
    "return_rate": "复诊率",
    "patients": "接诊人头",
    "visits_per_patient": "人次/人头",
    "registered_fee": "挂号费",
    "registered_cost": "挂号成本",
    "diagnosis_fee": "诊疗费",
    "diagnosis_cost": "诊疗费成本",
    "check_fee": "门诊检验费",
    "check_cost": "门诊检验成本",
    "medical_fee": "治疗费",
    "medical_cost": "治疗成本",
    "material_fee": "耗材",
    "material_cost": "耗材成本",
    "instrument_fee": "器械",
    "instrument_cost": "器械成本",
    "other1_fee": "生长激素",
    "other1_cost": "生长激素成本",
    "other2_fee": "器械1",
    "other2_cost": "器械1成本",
    "other3_fee": "自定义分类3",
    "other3_cost": "自定义分类3成本",
    "other4_fee": "自定义分类4",
    "other4_cost": "自定义分类4成本",
    "exam_in_room_fee": "科室体检费",
    "exam_in_room_cost": "科室体检成本费",
    "exam_check_fee": "体检检验费",
    "exam_check_cost": "体检检验成本",
    "exam_inspect_fee": "体检检查费",
    "exam_inspect_cost": "体检检查成本",
    "west_medicine_fee": "西药处方",
    "west_medicine_cost": "西药处方成本",
    "cp_medicine_fee": "中成药处方",
    "cp_medicine_cost": "中成药处方成本",
    "trad_medicine_fee": "中药处方",
    "trad_medicine_cost": "中药处方成本",
    "decoction_fee": "代煎费",
    "decoction_cost": "代煎费成本",
    "inspect_advice_fee": "门诊检查费",
    "inspect_advice_cost": "门诊检查成本",
    "other_fee": "其他收费",
    "other_cost": "其他收费成本",
    "total_price": "合计",
    "total_cost_price": "总成本",
    "gross_profit": "毛利润",
    "average_ticket": "客单价",
}

# Display names of the order lists and their sums.
INQUIRY_NAMES = {
    "inquiry_ord_id": "订单编号",
    "inquiry_type": "问诊类型",
    "user_name": "患者姓名",
    "bill_id": "患者联系方式",
    "doctor_name": "问诊医生",
    "doctor_phone": "医生联系方式",
    "department": "科室",
    "amount": "问诊金额",
    "create_date": "创建时间",
    "ord_state": "订单状态",
    "pay_state": "付款状态",
    "abnormal_state": "异常状态",
    "total_amount": "总金额",
}
ONLINE_NAMES = {
    "inquiry_ord_id": "订单编号",
    "create_date": "创建时间",
    "medical_ord_id": "结算单号",
    "user_name": "患者姓名",
    "department": "科室",
    "bill_id": "联系方式",
    "doctor_name": "开方医生",
    "amount": "支付金额",
    "ord_state": "订单状态",
    "pay_state": "付款状态",
    "pay_date": "付款时间",
    "total_amount": "支付总金额",
}

# Display names of the activity and threshold reports.
ACTIVITY_NAMES = {
    "doctor_name": "医生姓名",
    "referrer_name": "推荐人",
    "medical_institution": "所在医院",
    "department": "所在科室",
    "followers": "关注总数",
    "registrations": "报道总数",
    "period_start": "开始日期",
    "period_end": "结束日期",
    "new_followers": "新增关注量",
    "new_registrations": "新增报道量",
    "new_inquiries": "新增咨询量",
    "new_prescriptions": "新增医嘱数",
    "online_paid": "线上支付",
    "offline_paid": "线下支付",
}
THRESHOLD_NAMES = {
    "doctor_name": "医生姓名",
    "registrations": "累计新增报道数",
    "reached_at": "首次达到阈值时间",
    "threshold": "新增报道人数阈值",
    "interval": "统计区间",
}
DENSE_THRESHOLD_NAMES = {
    "doctor_name": "医生姓名",
    "threshold": "报道人数阈值",
    "reached_at": "首次达到阈值时间",
    "interval": "统计时间区间",
}
DETAIL_NAMES = {
    "doctor_name": "HCP姓名",
    "user_name": "NP姓名",
    "sex": "性别",
    "bill_id": "联系电话",
    "registered_at": "成功报道时间",
}


def decode(code: str, labels: Mapping, default: str = UNKNOWN) -> Column:
    """Label of a code; null counts as code 0, an unlisted code gets the default."""
    zero = type(next(iter(labels)))(0)
    pairs = ", ".join(literal(part) for pair in labels.items() for part in pair)
    filled = f"coalesce({name(code)}, {literal(zero)})"
    return F.expr(f"coalesce(try_element_at(map({pairs}), {filled}), {literal(default)})")


def two_way(code: str, rule: tuple) -> Column:
    """First label where the code equals the rule's code, else the second; null counts as code 0."""
    value, first, second = rule
    filled = f"coalesce({name(code)}, {literal(type(value)(0))})"
    return F.expr(f"CASE WHEN {filled} = {literal(value)} THEN {literal(first)} ELSE {literal(second)} END")
