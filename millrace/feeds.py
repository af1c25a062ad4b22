"""The delivery catalogue: which files exist, how they parse, where they land.

The catalogue is data.  The typed column maps are a parameter (see
:func:`millrace.config.column_maps_from_text` for a readable notation), and so
is the client name that the custodian puts into file names.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from millrace.config import ColumnMap, FeedSpec, SilverSpec


def catalogue(client: str, columns: Mapping[str, Mapping[str, ColumnMap]] | None = None) -> list[FeedSpec]:
    """All feeds of a client, in match order; ``columns`` maps bronze table to column map."""
    columns = columns or {}
    c, lower = re.escape(client), client.lower()
    # File name pattern, parser, bronze table, then what differs from a FeedSpec's
    # and a SilverSpec's defaults.  The first match wins.
    feeds = [
        FeedSpec(
            rf"{c}_INAVBSKT_ALL\.\d{{8}}\.csv", "pcf", "pcf_inav_baskets",
            silver=SilverSpec("pcf_inav_baskets", ("trade_date", "fund_ticker", "description", "ticker")),
        ),
        FeedSpec(
            rf"{c}_BSKT_ALL\.\d{{8}}\.csv", "pcf", "pcf_creation_baskets",
            silver=SilverSpec("pcf_creation_baskets", ("trade_date", "fund_ticker", "description", "ticker")),
        ),
        FeedSpec(
            r"All_Positions\d{8}\.csv", "csv", "all_positions",
            silver=SilverSpec("all_positions", ("source_file", "ss_id_cust", "ticker")),
        ),
        FeedSpec(
            r"PLF_Positions\d{8}\.csv", "csv", "plf_positions",
            silver=SilverSpec("plf_positions", ("source_file", "ss_id_cust", "ticker")),
        ),
        FeedSpec(
            rf"{c}_CIL_ALL\.\d{{8}}\.(csv|txt)", "cil", "cash_in_lieu_records",
            silver=SilverSpec("cash_in_lieu_records", ("record_date", "fund_ticker", "description")),
        ),
        FeedSpec(
            rf"{c}_INKIND\.\d{{8}}\.txt", "csv skip 1", "inkind_orders",
            silver=SilverSpec("inkind_orders", ("trade_date", "ss_id", "description", "ticker")),
        ),
        FeedSpec(
            rf"{c}_NAV_ALL\.\d{{8}}\.csv", "cil", "pcf_nav_records",
            silver=SilverSpec("pcf_nav_records", ("record_date", "fund_ticker")),
        ),
        FeedSpec(
            rf"{c}_Preburst_INKIND_ALL\.\d{{8}}\.txt", "csv skip 1", "preburst_inkind_orders",
            silver=SilverSpec("preburst_inkind_orders", ("trade_date", "ss_id", "description", "ticker")),
        ),
        FeedSpec(
            rf"{c} Price File -\d{{8}}\.(xls|xlsx)", "accounting_nav", "accounting_nav_records",
            silver=SilverSpec("accounting_nav_records", ("record_date", "ss_id", "fund_name")),
        ),
        FeedSpec(
            r"Accounting_Cash_Statement\.csv", "csv", "accounting_cash_statements", rename=True, load_type="overwrite",
            silver=SilverSpec("accounting_cash_statements", ("record_date", "ss_id", "cash_post_description", "cusip_id"), dedup_timestamp="record_date"),
        ),
        FeedSpec(
            r"All_Corporate_Actions\.csv", "csv", "all_corporate_actions", rename=True, load_type="overwrite",
            silver=SilverSpec("all_corporate_actions", ("notification_date", "ss_id", "event_id"), dedup_timestamp="notification_date"),
        ),
        FeedSpec(
            r"Cash_Forecast_Transactions\.csv", "csv", "cash_forecast_transactions", rename=True, load_type="overwrite",
            silver=SilverSpec("cash_forecast_transactions", ("record_datetime", "ss_id", "isin_id"), dedup_timestamp="trade_date"),
        ),
        FeedSpec(
            r"Custody_Positions\.csv", "csv", "custody_positions", rename=True,
            silver=SilverSpec("custody_positions", ("ingested_at", "ss_id", "security_name")),
        ),
        FeedSpec(
            r"Custody_Transactions\.csv", "csv", "custody_transactions", rename=True, load_type="overwrite",
            silver=SilverSpec("custody_transactions", ("record_datetime", "ss_id", "ss_trade_id"), dedup_timestamp="trade_date"),
        ),
        FeedSpec(
            r"Daily_Model_Holdings\.csv", "csv", "daily_model_holdings", rename=True,
            silver=SilverSpec("daily_model_holdings", ("record_date", "ss_id", "security_name")),
        ),
        FeedSpec(
            r"Daily_Net_Asset_Values\.csv", "csv", "daily_net_asset_values", rename=True,
            silver=SilverSpec("daily_net_asset_values", ("record_date", "ss_id", "fund_class")),
        ),
        FeedSpec(
            r"Distribution_Liability\.CSV", "csv", "distribution_liabilities", rename=True,
            silver=SilverSpec("distribution_liabilities", ("record_date", "ss_id", "gl_account_number")),
        ),
        FeedSpec(
            r"Loan_Balances\.csv", "csv", "loan_balances", rename=True,
            silver=SilverSpec("loan_balances", ("record_date", "ss_id", "gl_account_number")),
        ),
        FeedSpec(
            r"Opening_Cash_Balances\.csv", "csv", "opening_cash_balances", rename=True,
            silver=SilverSpec("opening_cash_balances", ("record_date", "ss_id")),
        ),
        FeedSpec(
            r"Pending_FX_Accounting\.csv", "csv", "pending_fx_accounting_records", rename=True,
            silver=SilverSpec("pending_fx_accounting_records", ("record_date", "ss_id", "trade_id")),
        ),
        FeedSpec(
            r"Top10_FX_Pending\.csv", "csv", "top10_fx_pending_records", rename=True,
            silver=SilverSpec("top10_fx_pending_records", ("record_date", "ss_id", "trade_id")),
        ),
        FeedSpec(
            r"Top10_Net_Asset_Value\.csv", "csv", "top10_net_asset_values", rename=True,
            silver=SilverSpec("top10_net_asset_values", ("record_date", "ss_id", "dual_pricing_basis")),
        ),
        FeedSpec(
            rf"{c}_UCF", "ucf", "ucf_records",
            silver=SilverSpec("ucf_records", ("trade_date", "fund_ticker", "description", "ticker")),
        ),
        FeedSpec(
            r"FPTRAD_report\.csv", "csv shifted", "daily_net_sales", rename=True,
            silver=SilverSpec("daily_net_sales", ("order_id", "trade_date", "ticker")),
        ),
        FeedSpec(
            r"^securities\.csv$", "csv", "all_securities", rename=True,
            silver=SilverSpec("ref_all_securities", ("figi_id",), table_type="reference"),
        ),
        FeedSpec(
            r"^exchanges\.csv$", "csv", "all_exchanges_codes", rename=True,
            silver=SilverSpec("ref_exchanges", ("iso_country", "equity_exch_code"), table_type="reference"),
        ),
        FeedSpec(
            rf"{c} Canadian ETF\.xlsx", "sheet", "cds_monthly_participant_reports",
            silver=SilverSpec("cds_monthly_participant_reports", ("report_date", "isin_id", "cuid_id")),
        ),
        FeedSpec(
            rf"{lower}_fund_identifiers\.csv", "csv", f"{lower}_fund_identifiers", rename=True,
            silver=SilverSpec(f"ref_{lower}_fund_identifiers", ("fund_ticker",), table_type="reference"),
        ),
        FeedSpec(
            r"history_all_distributions\.csv", "csv", "bbg_history_all_distributions", rename=True,
            silver=SilverSpec("bbg_history_all_distributions", ("ex_date", "ticker")),
        ),
        FeedSpec(
            r"bbg_history_all_funds_monthly_navs\.csv", "csv", "bbg_history_all_funds_monthly_navs", rename=True,
        ),
        FeedSpec(
            rf"{c}_\d{{4}}[-_]\d{{2}}[-_]\d{{2}}\.xlsx", "nbf", "nbf_wealth_changes_qq",
        ),
        FeedSpec(
            r"BMO_Q\d{1}_\d{4}\.xlsx", "bmo", "bmo_wealth_changes_qq",
            silver=SilverSpec("bmo_wealth_changes_qq", ("branch",)),
        ),
        FeedSpec(
            r"Branch_Mapping\.csv", "csv", "branch_mappings",
            silver=SilverSpec("ref_branch_mappings", ("broker", "branch_name"), table_type="reference"),
        ),
    ]
    return [f.with_columns(columns.get(f.bronze_table, {})) if f.silver else f for f in feeds]
