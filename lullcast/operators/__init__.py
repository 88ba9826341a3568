"""DataFrame operators of the forecasting dataflow."""
