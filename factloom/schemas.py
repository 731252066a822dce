"""Record schemas and the field groups that are extracted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

DEAL_FIELDS = ["acquirer", "acquirer_quote", "target", "target_quote", "deal_type", "deal_amount", "deal_amount_quote", "share_price", "payment_method", "target_valuation", "target_valuation_quote", "valuation_method", "performance_commitment", "performance_commitment_quote"]
PURPOSE_FIELDS = ["strategic_purpose", "strategic_purpose_quote", "synergy", "synergy_quote", "industry_logic", "industry_logic_quote", "summary"]
RECORDS = {"deal_summary": DEAL_FIELDS, "acquisition_purpose": PURPOSE_FIELDS}
#: What each target field holds, as told to the model.
ABOUT = {
    "acquirer": "the company that buys",
    "target": "the company or assets that are bought",
    "deal_type": "the kind of transaction, such as share purchase, merger by absorption or asset sale",
    "deal_amount": "the total price with its currency and unit",
    "share_price": "the price of each share that is issued",
    "payment_method": "how the price is paid: shares, cash or both, with their shares",
    "target_valuation": "the appraised value of what is bought, with the base date if stated",
    "valuation_method": "the appraisal method whose result is used",
    "performance_commitment": "the promised profits by year and what is due if they are missed",
    "strategic_purpose": "why the parties do the transaction",
    "synergy": "the advantages expected from joining the businesses",
    "industry_logic": "the state and trend of the industry that speak for the transaction",
    "summary": "the purpose of the transaction in two or three sentences",
}
SUCCESS, PARTIAL, FAILED = "success", "partial", "failed"

PAGE = "doc_id string, page_number int, text string"
CHUNK = "doc_id string, chunk_id int, text string, page int, section string, metadata map<string,string>"


def record_type(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), False) for f in fields])


@dataclass(frozen=True)
class SubFieldGroup:
    name: str
    query: str
    target_fields: tuple[str, ...]
    section_keywords: tuple[str, ...]
    hyde_query: str


# Target fields and section keywords of each group.
GROUPS = {
    "deal_summary": (
        SubFieldGroup("parties", "收购方 上市公司 标的公司 交易类型", ("acquirer", "target", "deal_type"), ("交易概述", "交易方案", "重大资产重组"), "谁收购了哪家公司,属于哪类交易?"),
        SubFieldGroup("pricing", "交易对价 发行价 支付方式", ("deal_amount", "share_price", "payment_method"), ("交易方案", "定价", "发行股份"), "交易总价、每股发行价和支付方式各是什么?"),
        SubFieldGroup("valuation", "标的估值 评估方法 评估值", ("target_valuation", "valuation_method"), ("评估", "估值", "定价"), "标的评估值是多少,用什么方法评估?"),
        SubFieldGroup("commitment", "业绩承诺 净利润 补偿", ("performance_commitment",), ("承诺", "补偿", "盈利预测"), "承诺期内的净利润和补偿安排是什么?"),
    ),
    "acquisition_purpose": (
        SubFieldGroup("strategy", "交易目的 必要性 战略", ("strategic_purpose",), ("目的", "必要性", "战略"), "为什么要进行本次交易?"),
        SubFieldGroup("synergy", "协同效应 整合", ("synergy",), ("协同", "整合", "效应"), "双方有哪些协同效应?"),
        SubFieldGroup("industry", "行业背景 市场", ("industry_logic", "summary"), ("行业", "市场", "背景"), "行业和市场背景如何?"),
    ),
}
MONOLITHIC = {"deal_summary": "交易概况 各方 对价 估值 承诺", "acquisition_purpose": "交易背景 目的 协同"}
