"""Every operator as a query over the driver's tables, with the same result as SQL.

A query puts a stand-in projection on a driver table (orders as registrations, customers
as athletes, …) and runs the library's own operator on it. The SQL states what must come
out, without the library.
"""
