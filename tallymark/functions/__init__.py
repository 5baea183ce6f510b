"""Column-level building blocks; no function here touches a DataFrame."""
