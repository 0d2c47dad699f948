"""Column in, column out. Nothing here touches a DataFrame."""
